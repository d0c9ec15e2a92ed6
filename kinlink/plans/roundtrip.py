"""Files that registries come in, written to the shared folder and read back by the readers; each with SQL over the tables themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinlink.session import cut, scratch, table
from kinlink.sources.feeds import hd_editions
from kinlink.sources.readers import ndjson
from kinlink.sources.sinks import append_edition, export_csv, export_ndjson

HD = ["unitid", "opeid", "instnm", "city", "stabbr", "zip", "sector"]
SECTOR_FROM = 2015  # earlier files lack the column, so the table has to be aligned by name


def csv_editions(spark: SparkSession, d: str) -> DataFrame:
    """ipeds_hd as one CSV file a year with differing columns, read as one table with the edition of each file's name."""
    h = cut(table(spark, d, "ipeds_hd").where("edition is not null").select("rec_id", *[F.col(c).cast("string").alias(c) for c in HD], "edition"))
    at, paths = scratch(spark), []
    for (year,) in sorted(h.select("edition").distinct().collect()):  # one file a year, as the publisher has it
        year_rows = h.where(F.col("edition") == year).select("rec_id", *HD)
        paths.append(f"{at}/hd{year}.csv")
        year_rows.drop(*([] if year >= SECTOR_FROM else ["sector"])).write.option("header", True).csv(paths[-1])
    return hd_editions(spark, paths).withColumn("rec_id", F.col("rec_id").cast("bigint"))


def ndjson_rows(spark: SparkSession, d: str) -> DataFrame:
    """ncaa_school as sorted JSON lines, read back by the names of its fields."""
    n, at = table(spark, d, "ncaa_school"), scratch(spark)
    export_ndjson(n, at, ["rec_id"])
    return ndjson(spark, at, [c for c in n.columns if c != "state"])


def appended_editions(spark: SparkSession, d: str) -> DataFrame:
    """nces_public appended edition by edition; what the table has already isn't appended again."""
    n, at = table(spark, d, "nces_public").select("rec_id", "ncessch", "name", "edition"), scratch(spark)
    append_edition(n.where("edition <= 2021"), at, ["edition"])
    append_edition(n, at, ["edition"])
    append_edition(n, at, ["edition"])
    return spark.read.parquet(at).select(n.columns)


def csv_report(spark: SparkSession, d: str) -> DataFrame:
    """Counties exported as a report and read back."""
    c, at = table(spark, d, "geography_county").drop("geom"), scratch(spark)
    export_csv(c, at, ["geoid"])
    return spark.read.csv(at, header=True)


QUERIES = {f.__name__: f for f in (csv_editions, ndjson_rows, appended_editions, csv_report)}

_TEXT = ", ".join(f"trim(CAST({c} AS VARCHAR)) AS {c}" for c in HD if c != "sector")
_NCAA = ["ncaa_code", "ceeb_code", "name", "address", "city", "zip", "message"]
SQL = {
    "csv_editions": f"SELECT rec_id, {_TEXT}, CASE WHEN edition >= {SECTOR_FROM} THEN CAST(sector AS VARCHAR) END AS sector, edition FROM ipeds_hd WHERE edition IS NOT NULL",
    "ndjson_rows": f"SELECT CAST(rec_id AS VARCHAR) AS rec_id, {', '.join(_NCAA)} FROM ncaa_school",
    "appended_editions": "SELECT rec_id, ncessch, name, edition FROM nces_public WHERE edition IS NOT NULL",
    "csv_report": "SELECT statefp, countyfp, geoid, namelsad, name, intptlat, intptlon, CAST(edition AS VARCHAR) AS edition FROM geography_county",
}
