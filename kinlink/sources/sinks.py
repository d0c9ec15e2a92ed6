"""Writers: whole tables, idempotent editions, exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def replace_table(df: DataFrame, path: str, partition_by: list[str] | None = None, cluster_by: list[str] | None = None) -> None:
    """Create or replace a Parquet table. cluster_by: its rows lie in this order, file by file, so scans can skip by statistics."""
    if cluster_by:
        df = df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
    w = df.write.mode("overwrite")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)


def create_if_absent(df: DataFrame, path: str) -> bool:
    """Write the table unless it exists; tells whether it was written."""
    if exists(df.sparkSession, path):
        return False
    df.write.parquet(path)
    return True


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def append_edition(df: DataFrame, path: str, keys: list[str]) -> None:
    """Add the editions (or edition and state) of df that the table lacks; those it has stay untouched.

    Appending twice adds nothing. The keys are partition columns, so what the table has is read from
    its folders.
    """
    spark = df.sparkSession
    if exists(spark, path):
        have = spark.read.parquet(path).select(*keys).distinct()
        df = df.join(have, keys, "left_anti")
    df.write.mode("append").partitionBy(*keys).parquet(path)


def replace_editions(df: DataFrame, path: str, keys: list[str]) -> None:
    """Overwrite the partitions df has rows of and leave the others."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def export_csv(df: DataFrame, path: str, order: list[str] | None = None) -> None:
    """One CSV file with header in UTF-8. For reports: one task writes it."""
    (df.orderBy(*order) if order else df).coalesce(1).write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)


def export_ndjson(df: DataFrame, path: str, order: list[str]) -> None:
    """A JSON object per line, sorted over all files."""
    df.orderBy(*order).write.mode("overwrite").json(path)
