"""What a session knows: tables, views, functions and databases."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def view(df: DataFrame, name: str) -> DataFrame:
    """Create or replace a view."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def has_table(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def has_function(spark: SparkSession, name: str) -> bool:
    return spark.catalog.functionExists(name)


def tables(spark: SparkSession) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables())


def databases(spark: SparkSession) -> list[str]:
    return sorted(d.name for d in spark.catalog.listDatabases())


def query(spark: SparkSession, text: str, **values) -> DataFrame:
    """A statement with named parameters (:name)."""
    return spark.sql(text, args=values)
