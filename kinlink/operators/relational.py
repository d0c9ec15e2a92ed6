"""Relational helpers: uniqueness gates, pools, padding unions, chained full joins, unpivot."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def qualify_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key occurs once (count over the key's partition = 1). A null key is a key like any other.

    Aggregated before any row moves with its payload: the keys that occur once are found by a partial
    aggregate and joined back null-safely, so a hot key costs one row per map task.
    """
    once = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n = 1").select(*[F.col(k).alias(f"_{k}") for k in keys])
    return df.join(once, [df[k].eqNullSafe(once[f"_{k}"]) for k in keys], "left_semi")


def narrowed(pool: DataFrame, taken: DataFrame, key: str) -> DataFrame:
    """The rows of pool whose key isn't taken; rows without key stay."""
    return pool.join(taken.select(key), key, "left_anti")


def union_by_name(*frames: DataFrame) -> DataFrame:
    """UNION ALL by column name, missing columns null; nothing is made distinct."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def each_column(df: DataFrame, fit: Callable[[str, str], bool], change: Callable[[Column], Column]) -> DataFrame:
    """df with change applied to all columns of which fit(name, type) holds; the plan is built from the schema."""
    return df.select(*[change(F.col(f"`{n}`")).alias(n) if fit(n, t) else F.col(f"`{n}`") for n, t in df.dtypes])


def survivorship(left: DataFrame, right: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """FULL JOIN on key with each field coalesced, left first; other columns of either side follow."""
    r = right.select(key, *[F.col(c).alias(f"_r_{c}") if c in left.columns else F.col(c) for c in right.columns if c != key])
    j = left.join(r, key, "full")
    both = [F.coalesce(c, f"_r_{c}").alias(c) for c in fields]
    rest = [c for c in left.columns if c not in (key, *fields)] + [c for c in right.columns if c not in (key, *left.columns)]
    return j.select(key, *both, *rest)


def top_k(df: DataFrame, by: list[str], order: list[Column], k: int) -> DataFrame:
    """The first k rows of each group; order must leave no ties."""
    return df.withColumn("_rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("_rank") <= k).drop("_rank")


def unpivoted(df: DataFrame) -> DataFrame:
    """(name, value): one row for each column of each row."""
    return df.unpivot([], df.columns, "name", "value")


def distinct_count_over(value: str, keys: list[str], df: DataFrame, out: str) -> DataFrame:
    """df with the number of different values per key, as a window of distinct counts would give; joined, not gathered."""
    n = df.groupBy(*keys).agg(F.count_distinct(value).alias(out)).select(*[F.col(k).alias(f"_{k}") for k in keys], out)
    return df.join(n, [df[k].eqNullSafe(n[f"_{k}"]) for k in keys]).select(*df.columns, out)


def share(part: Column, whole: Column) -> Column:
    """Rounded percentage, null where the whole is 0."""
    return F.round(F.try_divide(part, whole), 4) * 100
