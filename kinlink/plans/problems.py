"""Queries pN_ of the general problems: points, histories and drifting schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinlink.functions.values import county_code
from kinlink.operators.drift import changes, one_table
from kinlink.operators.history import versions
from kinlink.operators.nearby import containing, near_pairs, restored
from kinlink.session import cut, table

RADIUS_M = 150.0
EDITION = 2024


def positions(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nces_public").where(F.col("edition") == EDITION)
    h = table(spark, d, "ipeds_hd").where(F.col("edition") == EDITION)
    cols = lambda lat, lon, c: [F.col("rec_id").alias("id"), F.col(lat).cast("string").alias("lat"), F.col(lon).cast("string").alias("lon"), county_code(F.col(c)).alias("county")]
    both = n.select(*cols("lat", "lon", "cnty")).unionByName(h.select(*cols("latitude", "longitud", "countycd")))
    return restored(both, "lat", "lon").where("id is not null and y is not null").select("id", "y", "x", "county")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """near: pairs at most 150 m apart; region: the county around a row that names none or another."""
    p = cut(positions(spark, d))
    near = near_pairs(p.select("id", "y", "x"), RADIUS_M).select(F.lit("near").alias("kind"), "key_a", "key_b")
    regions = table(spark, d, "geography_county").select(F.col("geoid").alias("id"), "geom").where("id is not null")
    inside = containing(p, regions).where(~F.col("county").eqNullSafe(F.col("region")))
    region = inside.select(F.lit("region").alias("kind"), F.col("region").try_cast("bigint").alias("key_a"), F.col("id").alias("key_b")).distinct()
    return near.unionByName(region)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    v = versions(table(spark, d, "ipeds_hd"), "unitid", "edition", "instnm", "rec_id")
    return v.select(F.col("k").alias("unitid"), "valid_from", "valid_to")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return changes(table(spark, d, "ipeds_hd_raw"))


WANTED = {"instnm": "string", "addr": "string", "city": "string", "stabbr": "string", "zip": "string", "fips": "int", "countycd": "int", "latitude": "double", "longitud": "double", "f1systyp": "int", "sector": "int", "opeid": "string"}


def p6_table(spark: SparkSession, d: str) -> DataFrame:
    return one_table(table(spark, d, "ipeds_hd_raw"), WANTED)


QUERIES = {"p3_found": p3_found, "p5_found": p5_found, "p6_found": p6_found, "p6_table": p6_table}

# Fixed values as in kinlink.functions.values and kinlink.operators.nearby, written for SQL.
_STATED_LAT = "CASE WHEN a BETWEEN 24 AND 50 AND b BETWEEN 66 AND 125 THEN a WHEN b BETWEEN 24 AND 50 AND a BETWEEN 66 AND 125 THEN b END"
_STATED_LON = "CASE WHEN a BETWEEN 24 AND 50 AND b BETWEEN 66 AND 125 THEN -b WHEN b BETWEEN 24 AND 50 AND a BETWEEN 66 AND 125 THEN -a END"


def _degrees(c: str) -> str:
    s = f"replace(trim({c}), ',', '.')"
    dms = f"regexp_extract({s}, '^[+-]? ?([0-9]{{1,3}})°([0-9]{{1,2}})''([0-9.]+)', 1)"
    part = lambda i: dms.replace("', 1)", f"', {i})")
    plain = f"regexp_extract({s}, '^[+-]? *([0-9]+([.][0-9]*)?) *°? *[NSEWnsew]?$', 1)"
    v = f"coalesce(try_cast({part(1)} AS DOUBLE) + try_cast({part(2)} AS DOUBLE) / 60 + try_cast({part(3)} AS DOUBLE) / 3600, try_cast({plain} AS DOUBLE))"
    return f"CASE WHEN {v} > 1000 THEN {v} / 1000000 ELSE {v} END"


_P3 = f"""
WITH raw AS (
  SELECT rec_id AS id, CAST(lat AS VARCHAR) AS la, CAST(lon AS VARCHAR) AS lo, cnty AS c FROM nces_public WHERE edition = 2024
  UNION ALL SELECT rec_id, latitude, longitud, CAST(countycd AS VARCHAR) FROM ipeds_hd WHERE edition = 2024),
deg AS (SELECT id, {_degrees('la')} AS a, {_degrees('lo')} AS b, c FROM raw),
pos AS (SELECT id, {_STATED_LAT} AS y, {_STATED_LON} AS x,
  CASE WHEN regexp_matches(trim(c), '^[0-9]{{1,5}}$') THEN lpad(trim(c), 5, '0') END AS county FROM deg),
p AS (SELECT * FROM pos WHERE y IS NOT NULL AND x IS NOT NULL),
near AS (SELECT p.id AS ka, q.id AS kb FROM p JOIN p q ON p.id < q.id AND abs(p.y - q.y) <= 0.00135
  AND 2 * 6371000 * asin(sqrt(least(1, pow(sin(radians(q.y - p.y) / 2), 2) + cos(radians(p.y)) * cos(radians(q.y)) * pow(sin(radians(q.x - p.x) / 2), 2)))) <= 150)
SELECT 'near' AS kind, ka AS key_a, kb AS key_b FROM near
"""

_P5 = """
WITH n AS (SELECT unitid, edition, rec_id, lower(trim(regexp_replace(replace(instnm, '"', ''), '\\s+', ' ', 'g'))) AS v FROM ipeds_hd),
s AS (SELECT unitid, edition, arg_max(v, rec_id) AS v FROM n WHERE v IS NOT NULL AND v <> '' AND unitid IS NOT NULL AND edition IS NOT NULL GROUP BY 1, 2),
g AS (SELECT *, CASE WHEN v = lag(v) OVER (PARTITION BY unitid ORDER BY edition) THEN 0 ELSE 1 END AS starts FROM s),
r AS (SELECT *, sum(starts) OVER (PARTITION BY unitid ORDER BY edition) AS run FROM g)
SELECT unitid, min(edition) AS valid_from, max(edition) AS valid_to FROM r GROUP BY unitid, run
"""

# p3_found's regions need point-in-polygon, which plain SQL lacks; near pairs have SQL as p3_near.
SQL = {"p5_found": _P5, "p3_near": _P3}


def p3_near(spark: SparkSession, d: str) -> DataFrame:
    return p3_found(spark, d).where("kind = 'near'")


QUERIES["p3_near"] = p3_near
