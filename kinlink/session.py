"""Session settings and lineage cuts shared by all operators."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int = 8, name: str = "kinlink") -> SparkSession:
    """A local session for tests and the bench; on a cluster the caller brings the session."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", os.environ.get("KINLINK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir of the session.

    Only where that setting is absent (tests, one machine) a temporary folder of this
    machine is taken; a cluster must name its folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):  # also local-cluster is one machine
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    at = os.path.join(tempfile.gettempdir(), "kinlink-checkpoints")
    os.makedirs(at, exist_ok=True)
    return "file://" + at


def scratch(spark: SparkSession) -> str:
    """A new path in the application's part of the shared folder, which is removed when the driver's Python ends."""
    folder = f"{shared_dir(spark).rstrip('/')}/kinlink-{spark.sparkContext.applicationId}"
    if folder not in _folders:
        _folders[folder] = spark
        atexit.register(_remove, spark, folder)
    return f"{folder}/{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Compute df once and cut its lineage: a Parquet table in the shared folder.

    Columnar and compressed, it takes a fraction of the disk of a checkpointed RDD, and it outlives any executor.
    """
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_folders: dict[str, SparkSession] = {}


def _remove(spark: SparkSession, folder: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(folder)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the session may have ended before; the folder is then the cluster's to clear
        pass


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
