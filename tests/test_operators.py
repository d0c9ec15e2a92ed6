import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from kinlink.operators import drift
from kinlink.operators.cascade import Round, cascade, unique_join
from kinlink.operators.consolidate import earliest_non_null, latest_non_null
from kinlink.operators.history import versions
from kinlink.operators.nearby import EARTH_M, containing, degrees_in, near_pairs, restored, wkb_edges
from kinlink.operators.pairing import one_to_one, potential_duplicates, two_rounds, unpaired
from kinlink.operators.relational import narrowed, qualify_unique, survivorship, top_k, union_by_name, unpivoted
from kinlink.operators.search import BM25, bm25_top_k
from kinlink.session import cut


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_latest_skips_nulls_and_groups_null_keys(spark):
    d = spark.createDataFrame([(1, "old", 1), (1, None, 2), (None, "a", 1), (None, "b", 2)], "k int, v string, e int")
    assert rows(latest_non_null(d, "k", ["e"])) == [(1, "old", 2), (None, "b", 2)]
    assert rows(earliest_non_null(d, "k", ["e"])) == [(1, "old", 1), (None, "a", 1)]
    assert rows(latest_non_null(d.limit(0), "k", ["e"])) == []


def test_relational(spark):
    d = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "g int, v string")
    assert rows(qualify_unique(d, ["g"])) == [(2, "c"), (None, "d")]
    assert rows(narrowed(d, spark.createDataFrame([(1,)], "g int"), "g")) == [(2, "c"), (None, "d")]
    assert rows(union_by_name(d, spark.createDataFrame([(9,)], "w int")).select("g", "v", "w"))[-1] == (None, None, 9)
    assert rows(unpivoted(spark.createDataFrame([("1%", "2%")], "a string, b string"))) == [("a", "1%"), ("b", "2%")]
    assert rows(top_k(d, ["g"], [F.desc("v")], 1)) == [(1, "b"), (2, "c"), (None, "d")]
    l, r = spark.createDataFrame([(1, None, 5)], "k int, v string, x int"), spark.createDataFrame([(1, "r", 6), (2, "q", 7)], "k int, v string, y int")
    assert rows(survivorship(l, r, "k", ["v"])) == [(1, "r", 5, 6), (2, "q", None, 7)]


def test_chained_full_joins(spark):
    m = spark.createDataFrame([(1, "p")], "i int, s string")
    h = spark.createDataFrame([(2, "q")], "i int, s string")
    n = spark.createDataFrame([(2, "n"), (3, "o")], "i int, n string")
    assert rows(m.join(h, ["i", "s"], "full").join(n, "i", "full")) == [(1, "p", None), (2, "q", "n"), (3, None, "o")]


def test_cascade_rejects_then_matches_by_name(spark):
    c = "name string, address string, zip string"
    left = spark.createDataFrame([("l1", "x", "a", "1"), ("l2", "y", "a", "1"), (None, "z", None, "1")], f"l string, {c}")
    right = spark.createDataFrame([("r1", "x", "a", "1"), ("r2", "y", "a", "1"), ("r3", "z", None, "1")], f"r string, {c}")
    rounds = [Round("1", ("name", "address", "zip"), partition=("address", "zip")), Round("2", ("address", "zip"), ("name",)), Round("3", ("name", "zip"), ("address",))]
    got = cascade(left, right, "l", "r", rounds, cut)
    assert rows(got.select("l", "r", "strength")) == [("l1", "r1", "3) name, zip"), ("l2", "r2", "3) name, zip"), (None, "r3", "3) name, zip")]


def test_unique_join_hot_key_doesnt_multiply(spark):
    many = spark.range(20000).select(F.col("id").alias("l"), F.lit("hot").alias("k"))
    other = spark.range(20000).select(F.col("id").alias("r"), F.lit("hot").alias("k")).unionByName(spark.createDataFrame([(1, "one")], "r bigint, k string"))
    assert rows(unique_join(many.unionByName(spark.createDataFrame([(7, "one")], "l bigint, k string")), other, Round("1", ("k",))).select("l", "r")) == [(7, 1)]


def test_one_to_one(spark):
    l = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "l int, k string")
    r = spark.createDataFrame([(10, "a"), (20, "b")], "r int, k string")
    assert rows(one_to_one(l, r, ["k"], "l", "r").select("l", "r")) == [(1, 10)]


def test_rejected_pairs_dont_come_up_again(spark):
    c = "name string, zip string, state string"
    l = spark.createDataFrame([(1, "a", "1", "X"), (2, "b", "1", "X"), (3, "b", "1", "X"), (4, "c", "2", "X"), (5, None, "1", "X")], f"l int, {c}")
    r = spark.createDataFrame([(10, "a", "1", "X"), (20, "b", "1", "X"), (30, "c", "3", "X"), (40, "d", "1", "X"), (50, "b", "9", "Y")], f"r int, {c}")
    # 2 and 3 both meet 20, so neither is taken, and both have left when names and states are compared
    rounds = [["name", "zip"], ["name", "state"]]
    assert rows(two_rounds(l, r, "l", "r", rounds)) == [(1, 10, "1) name, zip"), (4, 30, "2) name, state")]
    known = spark.createDataFrame([(1, 10)], "l int, r int")
    d = potential_duplicates(l, r, known, "l", "r", rounds)
    left, right = unpaired(l, r, known, "l", "r", rounds)
    assert {x.l for x in d.collect()} == {2, 3, 4} and {x.r for x in d.collect()} == {20, 30}
    assert sorted(x.l for x in left.collect()) == [5] and sorted(x.r for x in right.collect()) == [40, 50]


def test_bm25_by_hand(spark):
    docs = spark.createDataFrame([("d1", "red fox", "oslo", "A"), ("d2", "red red dog", None, "a"), ("d3", "blue cat 9", "rome", "B"), ("d4", None, None, "A")], "id string, name string, city string, state string")
    q = spark.createDataFrame([("q1", "Réd red 7 zebra", "a"), ("q2", "99", "A")], "q string, text string, st string")
    p = BM25()
    got = {(r[0], r[1]): r[2] for r in bm25_top_k(q, "q", "text", docs, "id", ["name", "city"], ("st", "state"), 10, p).collect()}
    avg, idf = 9 / 4, math.log(1 + (4 - 2 + 0.5) / (2 + 0.5))
    score = lambda tf, n: idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * n / avg))
    assert got.keys() == {("q1", "d1"), ("q1", "d2")}
    assert got["q1", "d1"] == pytest.approx(score(1, 3), abs=1e-9) and got["q1", "d2"] == pytest.approx(score(2, 3), abs=1e-9)


def test_versions(spark):
    data = [
        (1, 1, 2009, "A", 1), (2, 1, 2010, " a ", 1), (3, 1, 2012, '"A"', 1), (4, 1, 2013, "B", 1), (5, 1, 2013, None, 1), (6, 1, 2014, "", 1), (7, 1, 2015, "B", 1), (8, 1, 2016, "A", 1),
        (9, 2, 2009, None, 1), (10, 3, 2010, "x", 1), (11, 3, 2010, "y", 1), (12, None, 2010, "z", 1), (13, 4, None, "z", 1), (13, 3, 2010, "y", 1),
    ]
    d = spark.createDataFrame(data, "rec bigint, unitid int, edition int, name string, k int")
    assert rows(versions(d, "unitid", "edition", "name", "rec").select("k", "valid_from", "valid_to")) == [(1, 2009, 2012), (1, 2013, 2015), (1, 2016, 2016), (3, 2010, 2010)]
    assert rows(versions(d.limit(0), "unitid", "edition", "name", "rec")) == []


def test_versions_against_plain_loop(spark):
    rnd = random.Random(5)
    data = [(i, rnd.randint(1, 30), rnd.randint(2009, 2016), rnd.choice(["a", "b", "A ", None])) for i in range(600)]
    got = rows(versions(spark.createDataFrame(data, "rec bigint, u int, e int, n string"), "u", "e", "n", "rec").select("k", "valid_from", "valid_to"))
    last: dict = {}
    for i, u, e, n in data:
        if n:
            last[u, e] = n.strip().lower()
    want = []
    for u in range(1, 31):
        run = None
        for e in range(2009, 2017):
            v = last.get((u, e))
            if v is None:
                continue
            if run and run[0] == v:
                run[2] = e
            else:
                if run:
                    want.append((u, run[1], run[2]))
                run = [v, e, e]
        if run:
            want.append((u, run[1], run[2]))
    assert got == sorted(want, key=str)


@pytest.mark.parametrize("v, want", [("38.5", 38.5), ("-38,5", 38.5), ("+30.25", 30.25), ("28816748", 28.816748), ("33°30'36.00\"N", 33.51), ("38.5 N", 38.5), ("36.04°N", 36.04), (".", None), ("", None), (None, None), ("-2", 2.0), ("4.5E7", 45.0)])
def test_degrees(spark, v, want):
    got = spark.createDataFrame([(v,)], "x string").select(degrees_in(F.col("x"))).first()[0]
    assert got is None if want is None else got == pytest.approx(want)


def test_restored(spark):
    d = spark.createDataFrame([("30", "-90"), ("-90", "30"), ("30", "90"), ("30000000", "-90000000"), ("0", "0"), (None, "-90"), ("30", "30")], "a string, b string")
    assert [(r.y, r.x) for r in restored(d, "a", "b").collect()] == [(30.0, -90.0)] * 4 + [(None, None)] * 3


def distance(p, q):
    r = math.radians
    h = math.sin(r(q[1] - p[1]) / 2) ** 2 + math.cos(r(p[1])) * math.cos(r(q[1])) * math.sin(r(q[2] - p[2]) / 2) ** 2
    return 2 * EARTH_M * math.asin(math.sqrt(min(1, h)))


@pytest.mark.parametrize("y, x", [(49.9, -80.0), (65.0, 20.0), (-65.01, -0.01), (-0.01, 0.0), (12.0, 179.99), (70.0, 179.95), (89.99, 0.0), (-89.999, 0.0)])
def test_near_pairs_against_brute_force(spark, y, x):
    rnd = random.Random(7)
    wide = min(0.02 / math.cos(math.radians(min(90, abs(y)))), 360)
    pts = [(i, max(-90.0, min(90.0, y + rnd.random() * 0.02)), (x + rnd.random() * wide + 180) % 360 - 180) for i in range(400)]
    more = [(1000, 30.0, -90.0), (1001, 30.0, -90.0), (1001, 30.0, -90.0), (1002, None, -90.0)]
    got = rows(near_pairs(spark.createDataFrame(pts + more, "id bigint, y double, x double"), 150.0))
    want = [(p[0], q[0]) for p in pts for q in pts if p[0] < q[0] and distance(p, q) <= 150] + [(1000, 1001)]
    assert got == sorted(want, key=str) and len(got) > 100


def square(x, y, s=1.0, hole=None):
    rings = [[(x, y), (x + s, y), (x + s, y + s), (x, y + s), (x, y)]] + ([hole] if hole else [])
    return bytearray(struct.pack("<BII", 1, 3, len(rings)) + b"".join(struct.pack(f"<I{2 * len(r)}d", len(r), *[v for p in r for v in p]) for r in rings))


def test_containing(spark):
    hole = [(-89.6, 30.4), (-89.4, 30.4), (-89.4, 30.6), (-89.6, 30.6), (-89.6, 30.4)]
    reg = spark.createDataFrame([("a", square(-90.0, 30.0, 1, hole)), ("b", square(-89.0, 30.0)), ("bad", bytearray(b"xx")), ("none", None)], "id string, geom binary")
    pts = spark.createDataFrame([(1, 30.2, -89.9), (2, 30.5, -89.5), (3, 30.5, -88.5), (4, 40.0, -89.0), (5, 30.5, -89.0), (6, None, None)], "id bigint, y double, x double")
    assert [r[:2] for r in rows(containing(pts, reg).select("id", "region"))] == [(1, "a"), (3, "b"), (5, "b")]
    assert wkb_edges(bytes(square(0, 0)))[0] == (0.0, 0.0, 1.0, 0.0)
    assert rows(containing(pts, reg.limit(0)).select("id")) == []


LINES = {
    "s_hd2009.csv": ["# note", "UNITID,INSTNM,SECTOR,LAT", "1,Alpha U,1,30.5", "2,Beta,2,31.25", "3,Gamma,4,", "broken,line", "1,Alpha U,1,30.5"],
    "s_hd2010.csv": ["﻿\"Unitid\";\"Institution\";\"Lat\";\"Zip\"", '"1";"Alpha U";"30.5 N";"01234"', '"2";"Beta";"31.25 N";"."', '"3";"Gamma; x";"-2";"-2"'],
    "s_hd2010_rv.csv": ["unitid|institution|lat|zip", "1|Alpha U|30|01234", "2|Beta|31|02345"],
}


def lines(spark):
    data = [("s", f, int(f[4:8]), k, x) for f, ls in LINES.items() for k, x in enumerate(ls, 1)] + [("s", "s_hd2010.csv", 2010, 2, LINES["s_hd2010.csv"][1]), ("s", "nohead.csv", 2009, 1, "a,b"), (None, "x", 2009, 1, "unitid,a"), ("s", "z.csv", 2009, 1, None)]
    return spark.createDataFrame(data, "series string, file_name string, edition int, line_no int, line string")


def test_schema_changes(spark):
    got = rows(drift.changes(lines(spark)))
    assert got == [
        ("s_hd2010.csv", "institution", "renamed"), ("s_hd2010.csv", "lat", "type"), ("s_hd2010.csv", "sector", "removed"), ("s_hd2010.csv", "zip", "added"), ("s_hd2010_rv.csv", "lat", "type"),
    ]
    assert rows(drift.changes(lines(spark).limit(0))) == []


def test_one_table(spark):
    got = rows(drift.one_table(lines(spark), {"instnm": "string", "lat": "double"}).select("edition", "unitid", "instnm", "lat"))
    assert (2009, "2", "Beta", 31.25) in got and (2010, "1", "Alpha U", 30.5) in got and (2010, "3", "Gamma; x", None) in got and len(got) == 9


RENAMED = {
    # the field comes under another name, then under the wanted one, then under a third
    "a_2009.csv": ["unitid,multi,Web", "1,1,w1", "2,2,w2", "3,1,w3"], "a_2010.csv": ["unitid,f1systyp,Web", "1,1,w1", "2,2,w2", "3,1,w3"], "a_2011.csv": ["unitid,kind,Web,edition", "1,1,w1,x", "2,2,w2,x", "3,1,w3,x"],
    # never under the wanted name, which only the other series tells
    "b_2009.csv": ["unitid,multi,Web", "7,2,w7"],
    # a name that went its way comes again for other content
    "c_2009.csv": ["unitid,f1systyp", "5,1", "6,2"], "c_2010.csv": ["unitid,other", "5,1", "6,2"], "c_2011.csv": ["unitid,other,f1systyp", "5,1,4", "6,2,3"],
    "d_2009.csv": ["unitid", "9"],
}


def test_one_table_keeps_every_field_under_any_name(spark):
    data = [(f[0], f, int(f[2:6]), k, x) for f, ls in RENAMED.items() for k, x in enumerate(ls, 1)]
    got = drift.one_table(spark.createDataFrame(data, "series string, file_name string, edition int, line_no int, line string"), {"f1systyp": "int"})
    assert got.columns == ["series", "file_name", "edition", "line_no", "unitid", "f1systyp", "edition_field", "other", "web"]
    by = {(r.file_name, r.unitid): r for r in got.collect()}
    assert len(by) == got.count() == 17
    assert [by[f"a_{y}.csv", u].f1systyp for y in (2009, 2010, 2011) for u in "123"] == [1, 2, 1] * 3
    assert by["a_2009.csv", "1"].web == "w1" and by["a_2011.csv", "3"].edition_field == "x" and by["d_2009.csv", "9"].f1systyp is None
    assert by["b_2009.csv", "7"].f1systyp == 2 and by["b_2009.csv", "7"].web == "w7"
    assert [by[f"c_{y}.csv", "5"].f1systyp for y in (2009, 2010, 2011)] == [1, 1, 4] and by["c_2011.csv", "5"].other == "1"


def test_name_classes():
    counts = {("file", x, x): n for x, n in (("lat", 2), ("latitude", 5), ("y", 1), ("addr", 9), ("webaddr", 4), ("county", 1), ("countynm", 3))}
    counts |= {("link", "lat", "latitude"): 2, ("link", "lat", "y"): 1, ("link", "addr", "webaddr"): 1, ("both", "addr", "webaddr"): 4, ("link", "county", "countynm"): 1, ("link", "addr", "latitude"): 1}
    assert drift.name_classes(counts, ["latitude", "addr"]) == {"lat": "latitude", "latitude": "latitude", "y": "latitude", "addr": "addr", "webaddr": "webaddr", "county": "countynm", "countynm": "countynm"}


def test_header_of():
    assert drift.header_of("a;UNITID ;b") == (";", ["a", "unitid", "b"])
    assert drift.header_of("x,y") is None and drift.header_of(None) is None
    assert drift.cells_of_line('"a ""q""";"b;c"', ";") == ['a "q"', "b;c"]
