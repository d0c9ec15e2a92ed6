"""All queries of the reference's own operators, with their SQL."""

from __future__ import annotations

from kinlink.plans import he, k12, roundtrip, star

_PLANS = [star, k12, he, roundtrip]
QUERIES = {k: f for p in _PLANS for k, f in p.QUERIES.items()}
SQL = {k: q for p in _PLANS for k, q in p.SQL.items()}
