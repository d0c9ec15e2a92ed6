"""Earlier, simpler matchers: strict one-to-one rounds and potential duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinlink.operators.relational import narrowed, union_by_name


def one_to_one(left: DataFrame, right: DataFrame, keys: list[str], left_id: str, right_id: str) -> DataFrame:
    """Rows equal on keys whose ids meet one different id each way; repeated pairs stay. Null keys never match.

    The counts of different partners are aggregated from the distinct pairs, not gathered in windows.
    """
    r = right.select(*keys, *[c for c in right.columns if c not in left.columns])
    j = left.join(r, keys)
    pairs = j.select(left_id, right_id).distinct()
    sole = lambda a: pairs.groupBy(a).agg(F.count(F.lit(1)).alias("_n")).where("_n = 1").select(a)
    return j.join(sole(left_id), left_id, "left_semi").join(sole(right_id), right_id, "left_semi")


def two_rounds(left: DataFrame, right: DataFrame, left_id: str, right_id: str, rounds: list[list[str]]) -> DataFrame:
    """(left_id, right_id, strength): one_to_one round by round.

    Whatever has a partner on a round's keys in the other table leaves the pool, whether the pair is one to one or not; so a
    pair that a round rejects doesn't come up again.
    """
    out = []
    for k, keys in enumerate(rounds, 1):
        won = one_to_one(left, right, keys, left_id, right_id)
        out.append(won.select(left_id, right_id, F.lit(f"{k}) {', '.join(keys)}").alias("strength")))
        of = lambda df: df.select(*keys).distinct()  # noqa: B023, E731
        left, right = left.join(of(right), keys, "left_anti"), right.join(of(left), keys, "left_anti")
    return union_by_name(*out)


def residual(pool: DataFrame, key: str, *matches: DataFrame) -> DataFrame:
    """The rows of pool whose key is in none of the matches; rows without key stay."""
    return narrowed(pool, union_by_name(*[m.select(key) for m in matches]), key)


def unpaired(left: DataFrame, right: DataFrame, known: DataFrame, left_id: str, right_id: str, rounds: list[list[str]]) -> tuple[DataFrame, DataFrame]:
    """What neither known nor potential_duplicates has, of either table: found by semi-joins, so no pair is made."""
    left0, right0 = narrowed(left, known, left_id), narrowed(right, known, right_id)
    pool, ids, r_ids = left0, [], []
    for keys in rounds:
        met = pool.join(right0.select(*keys).distinct(), keys, "left_semi").select(left_id)
        r_ids.append(right0.join(pool.select(*keys).distinct(), keys, "left_semi").select(right_id))
        ids.append(met)
        pool = narrowed(pool, met, left_id)
    return residual(left0, left_id, *ids), residual(right0, right_id, *r_ids)


def potential_duplicates(left: DataFrame, right: DataFrame, known: DataFrame, left_id: str, right_id: str, rounds: list[list[str]]) -> DataFrame:
    """(left_id, right_id, strength): rows not matched so far that are equal on the keys of a round, however many.

    Rows of left leave the pool once a round has joined them; right keeps all its rows.
    """
    left, right = narrowed(left, known, left_id), narrowed(right, known, right_id)
    out = []
    for keys in rounds:
        j = left.select(left_id, *keys).join(right.select(right_id, *keys), keys)
        out.append(j.select(left_id, right_id, F.lit(f"(potential duplicates) {', '.join(keys)}").alias("strength")))
        left = narrowed(left, j, left_id)
    return union_by_name(*out)
