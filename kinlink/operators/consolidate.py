"""One row per key out of several, field by field."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _picked(df: DataFrame, key: str, order: Column, pick, fields: list[str] | None) -> DataFrame:
    fields = fields or [c for c in df.columns if c != key]
    return df.groupBy(key).agg(*[pick(F.col(c), F.when(F.col(c).isNotNull(), order)).alias(c) for c in fields])


def latest_non_null(df: DataFrame, key: str, order: list[str], fields: list[str] | None = None) -> DataFrame:
    """Per key, each field's newest value that isn't null: the row is a composite.

    order, from most to least significant, must leave no ties. Null keys form one group. An aggregate
    with map-side partial results; a key of any number of rows is no hot task.
    """
    return _picked(df, key, F.struct(*order), F.max_by, fields)


def earliest_non_null(df: DataFrame, key: str, order: list[str], fields: list[str] | None = None) -> DataFrame:
    """As latest_non_null, with the oldest values."""
    return _picked(df, key, F.struct(*order), F.min_by, fields)
