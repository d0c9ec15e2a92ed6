"""Similarity of strings by their longest common subsequence, in Arrow batches."""

from __future__ import annotations

import re
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def lcs_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, bit-parallel over a (Hyyro 2004)."""
    if not a or not b:
        return 0
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | (1 << i)
    full = (1 << len(a)) - 1
    rows = full
    for c in b:
        hit = rows & at.get(c, 0)
        rows = ((rows + hit) | (rows - hit)) & full
    return len(a) - rows.bit_count()


@lru_cache(maxsize=100_000)
def indel_ratio_of(a: str, b: str) -> float:
    """1 - insertions and deletions / total length; two empty strings are equal."""
    return 2 * lcs_length(a, b) / (len(a) + len(b)) if a or b else 1.0


def sorted_words(s: str) -> str:
    """Lower case, everything but letters and digits a blank, words sorted."""
    return " ".join(sorted(re.sub(r"[\W_]+", " ", s.lower()).split()))


def token_sort_ratio_of(a: str, b: str) -> float:
    """indel ratio of the sorted words as whole percent, 0 if either has none."""
    x, y = sorted_words(a), sorted_words(b)
    return round(100 * indel_ratio_of(x, y)) / 100 if x and y else 0.0


def _pairwise(f):
    @F.pandas_udf("double")
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([f(x, y) if isinstance(x, str) and isinstance(y, str) else None for x, y in zip(a, b)], dtype="float64")

    return run


def indel_ratio(a: Column, b: Column) -> Column:
    """Null if either is null."""
    return _pairwise(indel_ratio_of)(a, b)


def token_sort_ratio(a: Column, b: Column) -> Column:
    return _pairwise(token_sort_ratio_of)(a, b)


def best_of_four(f, a: Column, b: Column, city: Column) -> Column:
    """The largest of f over a and b, each with and without the city behind it; null pairs don't count."""
    plus = lambda x: F.concat(x, F.lit(" "), city)
    return F.greatest(f(a, b), f(a, plus(b)), f(plus(a), b), f(plus(a), plus(b)))


def best_similarities(a: Column, b: Column, city: Column) -> Column:
    """(similarity_ratio, fuzz_ratio): best_of_four of both measures, in one pass over the batch."""

    @F.arrow_udf("struct<similarity_ratio:double,fuzz_ratio:double>")
    def run(a: pa.Array, b: pa.Array, city: pa.Array) -> pa.Array:
        out: list[list[float | None]] = [[], []]
        for x, y, c in zip(a.to_pylist(), b.to_pylist(), city.to_pylist()):
            sides = [[s for s in (v, f"{v} {c}" if c is not None else None) if s is not None] if v is not None else [] for v in (x, y)]
            for k, f in enumerate((indel_ratio_of, token_sort_ratio_of)):
                out[k].append(max((f(p, q) for p in sides[0] for q in sides[1]), default=None))
        return pa.StructArray.from_arrays([pa.array(v, pa.float64()) for v in out], ["similarity_ratio", "fuzz_ratio"])

    return run(a, b, city)


# The longest common subsequence, a row of its table for each letter of a, as lists of numbers: reduced from the first row
# over a's letters, and each row from [0] over b's letters with their places.
_LCS = """list_reduce(list_concat([list_transform(range(0, len({b}) + 1), lambda i: CAST(0 AS BIGINT))], list_transform(string_split({a}, ''), lambda c: [CAST(unicode(c) AS BIGINT)])),
  lambda above, ca: list_reduce(list_concat([[CAST(0 AS BIGINT)]], list_transform(range(1, len({b}) + 1), lambda j: [j, CAST(unicode({b}[j]) AS BIGINT)])),
    lambda now, jb: list_append(now, CASE WHEN jb[2] = ca[1] THEN above[jb[1]] + 1 ELSE greatest(above[jb[1] + 1], now[len(now)]) END)))[len({b}) + 1]"""


def indel_ratio_sql(a: str, b: str) -> str:
    """The same measures as expressions of DuckDB's SQL, for columns of that name."""
    return f"(CASE WHEN {a} = '' OR {b} = '' THEN CAST({a} = {b} AS INT) ELSE 2 * {_LCS.format(a=a, b=b)} / (len({a}) + len({b})) END)"


def sorted_words_sql(c: str) -> str:
    return f"array_to_string(list_sort(list_filter(string_split(regexp_replace(lower({c}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'), ' '), lambda w: w <> '')), ' ')"


def token_sort_ratio_sql(sorted_a: str, sorted_b: str) -> str:
    """Of columns of sorted words."""
    return f"CASE WHEN {sorted_a} = '' OR {sorted_b} = '' THEN 0.0 ELSE round_even(100 * {indel_ratio_sql(sorted_a, sorted_b)}, 0) / 100 END"
