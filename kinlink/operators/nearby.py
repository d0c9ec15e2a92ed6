"""Points near points and points in regions, over a grid."""

from __future__ import annotations

import math
import struct

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EARTH_M = 6_371_000.0
DEGREE_M = EARTH_M * math.pi / 180
# All true positions lie in this box.
LATITUDES, LONGITUDES = (24.0, 50.0), (-125.0, -66.0)


def degrees_in(c: Column) -> Column:
    """Size of an angle in any written form, in degrees without sign; null if there is none.

    Knows plain numbers, decimal commas, signs, hemisphere letters, degree signs, degrees with
    minutes and seconds, and millionths of a degree stored as whole numbers.
    """
    s = F.replace(F.trim(c.cast("string")), F.lit(","), F.lit("."))
    dms = r"^[+-]?\s*(\d{1,3})\s*[°d: ]\s*(\d{1,2})\s*['′m: ]\s*(\d{1,2}(?:\.\d+)?)"
    part = lambda i: F.regexp_extract(s, dms, i).try_cast("double")
    sexagesimal = part(1) + part(2) / 60 + part(3) / 3600
    number = F.regexp_extract(s, r"^[+-]?\s*(\d+(?:\.\d*)?(?:[eE][+-]?\d+)?)\s*°?\s*[NSEWnsew]?$", 1).try_cast("double")
    v = F.coalesce(sexagesimal, number)
    return F.when(v > 1000, v / 1e6).otherwise(v)


def restored(df: DataFrame, lat: str, lon: str) -> DataFrame:
    """df with y and x, the position in degrees, null where it can't be restored.

    Signs lost, coordinates swapped and millionths are put right: the box of true positions
    admits one reading at most, as no latitude in it has the size of a longitude.
    """
    a, b = degrees_in(F.col(lat)), degrees_in(F.col(lon))
    is_lat = lambda v: v.between(*LATITUDES)
    is_lon = lambda v: v.between(-LONGITUDES[1], -LONGITUDES[0])
    straight, swapped = is_lat(a) & is_lon(b), is_lat(b) & is_lon(a)
    return df.withColumn("y", F.when(straight, a).when(swapped, b)).withColumn("x", F.when(straight, -b).when(swapped, -a))


def haversine_m(y1: Column, x1: Column, y2: Column, x2: Column) -> Column:
    r = F.radians
    h = F.pow(F.sin(r(y2 - y1) / 2), 2) + F.cos(r(y1)) * F.cos(r(y2)) * F.pow(F.sin(r(x2 - x1) / 2), 2)
    return 2 * EARTH_M * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def near_pairs(points: DataFrame, radius_m: float) -> DataFrame:
    """(key_a, key_b), key_a < key_b, of points (id, y, x) at most radius_m apart, anywhere on the globe.

    Rows of the grid are as high as the radius. Each row has cells of its own width: at least the difference in
    longitude that two points so near each other can have in the row and those beside it, so a neighbour lies in one of the nine cells
    around; they close over the 180th meridian. Each point is sent to its cell, the next one of its row
    and three of the row above; two points meet in one cell once. Repeated rows give a pair once; points without
    position have no neighbours. The work is in proportion to the points and the pairs that come out, as a cell is about
    as large as the radius; cells of many points are split by adaptive execution's skew join.
    """
    tall = radius_m / DEGREE_M * 1.000001
    lon = F.pmod(F.col("x") + 180.0, F.lit(360.0))

    def cells(row: Column) -> Column:
        """How many cells a row has."""
        most = F.least(F.greatest(F.abs((row - 1) * tall), F.abs((row + 2) * tall)), F.lit(90.0))
        reach = 2 * F.degrees(F.asin(F.least(F.lit(math.sin(radius_m / EARTH_M / 2)) / F.greatest(F.cos(F.radians(most)), F.lit(1e-12)), F.lit(1.0)))) * 1.000001
        return F.greatest(F.floor(360.0 / reach), F.lit(1)).cast("long")

    def column(n: Column) -> Column:
        return F.least(F.floor(lon / (360.0 / n)).cast("long"), n - 1)

    p = points.where("y is not null and x is not null").select("id", "y", "x").distinct()
    p = p.withColumn("cy", F.floor(F.col("y") / tall).cast("long")).withColumns({"n": cells(F.col("cy")), "up": cells(F.col("cy") + 1)})
    p = p.withColumns({"cx": column(F.col("n")), "ux": column(F.col("up"))})
    home = p.select("cy", "cx", F.col("id").alias("a"), F.col("y").alias("ay"), F.col("x").alias("ax"))
    at = lambda cy, cx, own: F.struct(cy.alias("cy"), cx.alias("cx"), F.lit(own).alias("own"))
    # in a row of two cells each is next to the other, which is the same pair of cells
    beside = F.when((F.col("n") > 2) | ((F.col("n") == 2) & (F.col("cx") == 0)), at(F.col("cy"), F.pmod(F.col("cx") + 1, F.col("n")), False))
    above = [at(F.col("cy") + 1, F.pmod(F.col("ux") + d, F.col("up")), False) for d in (-1, 0, 1)]
    away = p.withColumn("c", F.explode(F.array_distinct(F.array_compact(F.array(at(F.col("cy"), F.col("cx"), True), beside, *above)))))
    away = away.select("c.*", F.col("id").alias("b"), F.col("y").alias("by"), F.col("x").alias("bx"))
    j = home.join(away, ["cy", "cx"]).where((~F.col("own") & (F.col("a") != F.col("b"))) | (F.col("a") < F.col("b")))
    j = j.where((F.abs(F.col("ay") - F.col("by")) <= tall) & (haversine_m(F.col("ay"), F.col("ax"), F.col("by"), F.col("bx")) <= radius_m))
    return j.select(F.least("a", "b").alias("key_a"), F.greatest("a", "b").alias("key_b"))


def wkb_edges(wkb: bytes | None) -> list[tuple[float, float, float, float]]:
    """Edges (x1, y1, x2, y2) of all rings of a WKB polygon or multipolygon; none for other kinds."""
    if not wkb:
        return []
    edges: list[tuple[float, float, float, float]] = []

    def one(at: int) -> int:
        e = "<" if wkb[at] == 1 else ">"
        kind, at = struct.unpack_from(e + "I", wkb, at + 1)[0], at + 5
        if kind & 0x20000000:  # an SRID follows
            at += 4
        dims = 2 + bool(kind & 0x80000000) + bool(kind & 0x40000000) + (kind % 0x10000000 // 1000 in (1, 2)) + 2 * (kind % 0x10000000 // 1000 == 3)
        kind = kind & 0xFFFF
        n, at = struct.unpack_from(e + "I", wkb, at)[0], at + 4
        if kind % 1000 == 6:
            for _ in range(n):
                at = one(at)
            return at
        if kind % 1000 != 3:
            raise ValueError("no polygon")
        for _ in range(n):
            m, at = struct.unpack_from(e + "I", wkb, at)[0], at + 4
            xy = struct.unpack_from(f"{e}{m * dims}d", wkb, at)
            at += 8 * m * dims
            pts = [(xy[i], xy[i + 1]) for i in range(0, m * dims, dims)]
            edges.extend((*p, *q) for p, q in zip(pts, pts[1:]) if p != q)
        return at

    try:
        one(0)
    except (struct.error, ValueError, IndexError):
        return []
    return edges


def containing(points: DataFrame, regions: DataFrame, cell_deg: float = 0.25) -> DataFrame:
    """points joined to the regions (id, geom as WKB) that contain them, as column region.

    Regions are cut into the grid cells of their bounding boxes, points meet the regions of
    their cell, and the even-odd rule over the edges decides; an edge's lower end counts, so a
    point on the line between two regions is in one of them. Regions that can't be read and
    points without position give no rows. Nothing is broadcast by hand: where the regions
    are few, Spark sees that from their size.
    """
    edges_type = "array<struct<x1:double,y1:double,x2:double,y2:double>>"

    @F.pandas_udf(edges_type)
    def edges_of(g: pd.Series) -> pd.Series:
        return g.map(lambda b: [dict(zip(("x1", "y1", "x2", "y2"), e)) for e in wkb_edges(b)])

    r = regions.select(F.col("id").alias("region"), edges_of("geom").alias("edges")).where(F.size("edges") > 0)
    lo = lambda f, g: F.floor(F.array_min(F.transform("edges", lambda e: F.least(e[f], e[g]))) / cell_deg)
    hi = lambda f, g: F.floor(F.array_max(F.transform("edges", lambda e: F.greatest(e[f], e[g]))) / cell_deg)
    r = r.withColumn("gy", F.explode(F.sequence(lo("y1", "y2"), hi("y1", "y2")))).withColumn("gx", F.explode(F.sequence(lo("x1", "x2"), hi("x1", "x2"))))
    p = points.where("y is not null and x is not null").withColumn("gy", F.floor(F.col("y") / cell_deg)).withColumn("gx", F.floor(F.col("x") / cell_deg))
    crossed = lambda e: ((e["y1"] > F.col("y")) != (e["y2"] > F.col("y"))) & (F.col("x") < (e["x2"] - e["x1"]) * (F.col("y") - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"])
    j = p.join(r, ["gy", "gx"])
    # the division is guarded: a level edge is never crossed
    inside = F.size(F.filter("edges", lambda e: F.when(e["y1"] == e["y2"], False).otherwise(crossed(e)))) % 2 == 1
    return j.where(inside).drop("gy", "gx", "edges")
