"""Validity periods of a changing attribute, from periodic snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinlink.functions.values import squeezed


def name_key(c: Column) -> Column:
    """Equal for names that count as the same: no quote marks, case or surplus blanks."""
    return F.lower(squeezed(F.replace(c, F.lit('"'), F.lit(""))))


def snapshot_of(df: DataFrame, key: str, edition: str, value: str, order: str) -> DataFrame:
    """(k, e, v): per key and edition the value of the row latest by order that has one.

    Rows without key, edition or value (null, blank or quote marks only) say nothing. Ties
    in order are settled by the larger value.
    """
    d = df.select(F.col(key).alias("k"), F.col(edition).alias("e"), F.col(order).alias("o"), name_key(F.col(value).cast("string")).alias("v"))
    d = d.where("k is not null and e is not null and v is not null and v != ''")
    return d.groupBy("k", "e").agg(F.max_by("v", F.struct("o", "v")).alias("v"))


def snapshot_changes(snap: DataFrame) -> DataFrame:
    """Change events (k, at, kind, v, e, last) between consecutive editions of snap (k, e, v).

    Each edition is joined to the one before it by a null-safe full outer join; all editions
    go in one join, as the edition is part of its key. at counts editions in order; e is the
    edition of the new value and last the edition before, in which the old value was seen.
    kind: inserted, changed, deleted (kept rows are no event). The end of the last edition
    deletes every key that is left.
    """
    # the calendar of editions is as long as the number of snapshots and is not collected
    cal = snap.select("e").distinct().withColumn("n", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy("e")))
    s = snap.join(cal, "e")
    new = s.select(F.col("k").alias("nk"), F.col("n").alias("nn"), F.col("v").alias("nv"), F.col("e").alias("ne"))
    old = s.select(F.col("k").alias("ok"), (F.col("n") + 1).alias("on"), F.col("v").alias("ov"), F.col("e").alias("oe"))
    j = new.join(old, F.col("nk").eqNullSafe(F.col("ok")) & F.col("nn").eqNullSafe(F.col("on")), "full")
    kind = F.when(F.col("ok").isNull(), "inserted").when(F.col("nk").isNull(), "deleted").when(~F.col("nv").eqNullSafe(F.col("ov")), "changed")
    return j.select(
        F.coalesce("nk", "ok").alias("k"), F.coalesce("nn", "on").alias("at"), kind.alias("kind"),
        F.col("nv").alias("v"), F.col("ov").alias("old"), F.col("ne").alias("e"), F.col("oe").alias("last"),
    ).where("kind is not null")


def validity(events: DataFrame) -> DataFrame:
    """(k, v, valid_from, valid_to) from change events: a gap doesn't end a version.

    A key that comes back with the value it left with goes on with its version. valid_to is
    the last edition in which the value was seen before the next version's first.
    """
    w = Window.partitionBy("k").orderBy("at")
    seen = events.withColumn("before", F.last("v", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    starts = F.col("v").isNotNull() & ~F.col("v").eqNullSafe(F.col("before"))
    run = seen.withColumn("starts", starts)
    # what ended before a start is told by the latest event up to and including the next start
    ended = F.last("last", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    run = run.withColumn("ended", ended)
    final = F.last("ended", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    v = run.withColumn("final", final).where("starts")
    return v.select("k", "v", F.col("e").alias("valid_from"), F.coalesce(F.lead("ended").over(w), F.col("final")).alias("valid_to"))


def versions(df: DataFrame, key: str, edition: str, value: str, order: str) -> DataFrame:
    """All versions of value per key with their period: snapshots, differences, validity.

    Nulls: see snapshot_of. Repeated rows change nothing; an empty table gives no rows; other
    columns are ignored whatever their names. The number of rows of a key that meet in one
    task is at most its number of changes, never its number of rows.
    """
    return validity(snapshot_changes(snapshot_of(df, key, edition, value, order)))
