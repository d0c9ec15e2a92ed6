"""One surviving record for each group of duplicate records, by votes on every field."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinlink.functions.values import STAND_INS, squeezed, usable


def value_key(c: Column) -> Column:
    """Equal for values that vote together: case, blanks and punctuation don't count."""
    return F.coalesce(F.nullif(F.regexp_replace(F.lower(squeezed(c)), r"[^\p{L}\p{N}]+", ""), F.lit("")), F.lower(squeezed(c)))


# Votes are summed in steps of so many half-lives; what is two steps older weighs less than 2**-STEP.
STEP = 64


def votes(rows: DataFrame, fields: dict[str, list[str]], half_life_days: float | None) -> DataFrame:
    """(grp, field, value, rec, at, vote): the winner of each group and field, over long rows.

    rows: grp (of any type), rec (bigint), at (timestamp; null is oldest), trust (double) and
    the fields, each with its stand-ins. The fields are unpivoted, values that aren't usable
    drop out, and each normalised value sums trust times a weight that halves every half_life_days.
    The most votes win (vote is their logarithm to base 2), then the newest row. half_life_days None is instant
    decay: a vote weighs more than all older ones, so a value's votes are those at its newest instant.
    Newest is by at, then rec. The stated value of the winner is that of its newest row.

    Sums are kept as a step of recency and a sum within it, so no half-life is too short for them: a vote at
    exponent x is trust * 2**(x - STEP * k) in step k, an instant being a step of its own where decay is instant. A
    value's newest step and the one before it make its vote. All are aggregates with map-side partial sums: a
    group of any number of rows sends one row per value, step and map task, and no group is gathered.
    """
    unpivoted = F.explode(F.array(*[F.when(usable(F.col(f), s), F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value"))) for f, s in fields.items()])).alias("c")
    long = rows.select("grp", "rec", "at", "trust", unpivoted).where("c is not null").select("grp", "rec", "at", "trust", "c.field", "c.value")
    order = F.struct(F.coalesce(F.col("at"), F.lit("0001-01-01").cast("timestamp_ntz")).alias("at"), "rec")
    if half_life_days is None:
        exponent, k, instant = F.lit(0.0), F.lit(0).cast("bigint"), order
    else:
        exponent = F.coalesce(F.datediff(F.col("at"), F.lit("2030-01-01")), F.lit(-20000)) / F.lit(half_life_days)
        k, instant = F.floor(exponent / STEP), F.lit(None).cast("struct<at:timestamp_ntz,rec:bigint>")
    weight = F.col("trust") * F.pow(F.lit(2.0), exponent - STEP * k)
    # values are told apart within their group only, so 64 bits do
    step = long.select("grp", "field", F.xxhash64(value_key(F.col("value"))).alias("same"), k.alias("k"), instant.alias("instant"), F.struct(order.alias("order"), "value").alias("n"), weight.alias("s"))
    # an instant has one row, whose vote is its step's sum
    keys = ["grp", "field", "same", "k", "instant"]
    steps = step if half_life_days is None else step.groupBy(*keys).agg(F.max("n").alias("n"), F.sum("s").alias("s"))
    # the step before the newest has the other parity
    even, of_step = F.col("k") % 2 == 0, F.struct("k", "instant", "s")
    by_value = steps.groupBy("grp", "field", "same").agg(F.max("n").alias("n"), F.max(F.when(even, of_step)).alias("even"), F.max(F.when(~even, of_step)).alias("odd"))
    by_value = by_value.withColumns({"a": F.greatest("even", "odd"), "b": F.when(F.col("even").isNotNull() & F.col("odd").isNotNull(), F.least("even", "odd"))})
    total = F.col("a.s") + F.when(F.col("b.k") == F.col("a.k") - 1, F.col("b.s") * 2.0**-STEP).otherwise(0.0)
    m = F.struct(F.col("a.instant").alias("instant"), (F.col("a.k") * STEP + F.log2(total)).alias("vote"), F.col("n.order").alias("order"), F.col("n.value").alias("value"))
    best = by_value.select("grp", "field", m.alias("m")).groupBy("grp", "field").agg(F.max("m").alias("m"))
    return best.select("grp", "field", F.col("m.value").alias("value"), F.col("m.order.rec").alias("rec"), F.col("m.order.at").alias("at"), F.col("m.vote").alias("vote"))


def duplicated(rows: DataFrame) -> DataFrame:
    """The groups (grp) of at least two rows."""
    return rows.where("grp is not null").groupBy("grp").agg(F.count(F.lit(1)).alias("n")).where("n >= 2").select("grp")


def survivors(rows: DataFrame, fields: dict[str, list[str]] | list[str], half_life_days: float | None = 730.0) -> DataFrame:
    """One row per group: grp and each field's winning value, null where no row has a usable one.

    The votes' winners are pivoted back. Groups of one row survive as they are (their values where
    usable); rows without grp belong to none. An empty table gives no rows.
    """
    f = fields if isinstance(fields, dict) else dict.fromkeys(fields, STAND_INS)
    won = votes(rows.where("grp is not null"), f, half_life_days)
    wide = won.groupBy("grp").agg(*[F.max(F.when(F.col("field") == k, F.col("value"))).alias(k) for k in f])
    return rows.where("grp is not null").select("grp").distinct().join(wide, "grp", "left")
