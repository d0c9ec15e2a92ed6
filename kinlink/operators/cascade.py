"""Rounds of ever looser exact joins, each gated by uniqueness."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinlink.operators.relational import narrowed, union_by_name


@dataclass(frozen=True)
class Round:
    """Rows equal on keys match if their joined rows are the only ones with the same partition keys.

    left_out: columns of which the match keeps the right side's values.
    """

    label: str
    keys: tuple[str, ...]
    left_out: tuple[str, ...] = ()
    partition: tuple[str, ...] = ()

    @property
    def strength(self) -> str:
        return f"{self.label}) {', '.join(self.keys)}"


def unique_join(left: DataFrame, right: DataFrame, r: Round) -> DataFrame:
    """INNER JOIN USING the keys, kept where it gives one row per partition key. Null keys never match.

    Joined rows are counted before they are made: each side is reduced to one row per key with the number
    it stands for (partial aggregates), the product is what the join would give, and its sum over the
    partition keys must be 1. So names that many rows bear never multiply.
    """
    keys, part = list(r.keys), list(r.partition or r.keys)
    l_cols = [c for c in left.columns if c not in (*keys, *r.left_out)]
    r_cols = [c for c in right.columns if c not in keys and c not in l_cols]
    one = lambda df, cols, n, v: df.where(" and ".join(f"`{k}` is not null" for k in keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias(n), F.first(F.struct(*cols)).alias(v))
    j = one(left, l_cols, "_nl", "_l").join(one(right, r_cols, "_nr", "_r"), keys).withColumn("_n", F.col("_nl") * F.col("_nr"))
    if set(part) != set(keys):
        total = j.groupBy(*part).agg(F.sum("_n").alias("_n_all")).where("_n_all = 1").select(*part)
        j = j.join(total, part, "left_semi")
    return j.where("_n = 1").select(*keys, *[F.col(f"_l.{c}").alias(c) for c in l_cols], *[F.col(f"_r.{c}").alias(c) for c in r_cols], F.lit(r.strength).alias("strength"))


def _unique_pairs(left: DataFrame, right: DataFrame, r: Round) -> DataFrame:
    """(_l, _r) of the rows that unique_join would join."""
    keys, part = list(r.keys), list(r.partition or r.keys)
    one = lambda df, n, row: df.where(" and ".join(f"`{k}` is not null" for k in keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias(n), F.max(row).alias(row))
    j = one(left, "_nl", "_l").join(one(right, "_nr", "_r"), keys).withColumn("_n", F.col("_nl") * F.col("_nr"))
    if set(part) != set(keys):
        total = j.groupBy(*part).agg(F.sum("_n").alias("_n_all")).where("_n_all = 1").select(*part)
        j = j.join(total, part, "left_semi")
    return j.where("_n = 1").select("_l", "_r")


def cascade(left: DataFrame, right: DataFrame, left_id: str, right_id: str, rounds: list[Round], cut) -> DataFrame:
    """All rounds' matches; a round's matches leave either pool by their own id, its rejects stay.

    Rounds run on numbered rows with their id and keys alone; pools are cut once a round, as each feeds the next one
    twice, and all other columns join the matches at the end. Rows without id stay in the pools.
    """
    number = lambda df, row: cut(df.withColumn(row, F.monotonically_increasing_id()))
    left, right = number(left, "_l"), number(right, "_r")
    keys = list(dict.fromkeys(k for r in rounds for k in (*r.keys, *r.partition)))
    pools = [left.select("_l", *dict.fromkeys([left_id, *keys])), right.select("_r", *dict.fromkeys([right_id, *keys]))]
    out = []
    for k, r in enumerate(rounds):
        won = cut(_unique_pairs(*pools, r).withColumn("strength", F.lit(r.strength)))
        out.append(won)
        if k + 1 < len(rounds):
            for i, (row, name) in enumerate((("_l", left_id), ("_r", right_id))):
                taken = pools[i].join(won.select(row), row, "left_semi")
                pools[i] = cut(narrowed(pools[i], taken, name))
    from_right = {c: [r.strength for r in rounds if c in r.left_out and c not in r.keys] for c in left.columns if c in right.columns}
    column = lambda c: F.when(F.col("strength").isin(from_right[c]), F.col(f"r.{c}")).otherwise(F.col(f"l.{c}")) if c in from_right else F.col(f"{'l' if c in left.columns else 'r'}.{c}")
    columns = [c for c in dict.fromkeys([*left.columns, *right.columns]) if c not in ("_l", "_r")]
    pairs = union_by_name(*out).alias("p")
    j = pairs.join(left.alias("l"), F.col("p._l") == F.col("l._l")).join(right.alias("r"), F.col("p._r") == F.col("r._r"))
    return j.select(*[column(c).alias(c) for c in columns], "strength")
