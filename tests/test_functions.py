import random
from functools import lru_cache

import duckdb
import pytest
from pyspark.sql import functions as F

from kinlink.functions import rules
from kinlink.functions.regex import Rule, re2_to_java, replace_all, replace_first, rewrite, rewrite_sql, tighten
from kinlink.functions.similarity import indel_ratio, indel_ratio_of, lcs_length, token_sort_ratio, token_sort_ratio_of
from kinlink.functions.values import county_code, digit_code, usable, zip5


def one(spark, c, value):
    return spark.createDataFrame([(value,)], "x string").select(c(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    "text, pattern, by, first, every",
    [
        ("aXbX", "X", "-", "a-bX", "a-b-"),
        ("a & b & c", r"(\w) & (\w)", r"\1&\2", "a&b & c", "a&b & c"),
        ("ab\n", "b$", "Z", "ab\n", "ab\n"),
        ("él", r"\bl", "Z", "éZ", "éZ"),
        ("a.b", r"\.", "$", "a$b", "a$b"),
        ("x\ny", r"\s", "_", "x_y", "x_y"),
        ("", "a*", "z", "z", "z"),
        (None, "a", "b", None, None),
    ],
)
def test_dialect(spark, text, pattern, by, first, every):
    assert one(spark, lambda c: replace_first(c, pattern, by), text) == first
    assert one(spark, lambda c: replace_all(c, pattern, by), text) == every


def test_class_keeps_dollar():
    assert re2_to_java(r"[$a]$") == r"[$a]\z"


@pytest.mark.parametrize("text, want", [("p s 12", "ps 12"), ("a b c d", "abcd"), ("ab c", "ab c"), ("x y, z", "x y, z"), ("j r r tolkien", "jrr tolkien")])
def test_tighten(spark, text, want):
    assert one(spark, tighten, text) == want


NAMES = ["St. Mary's H S", "P.S. 12 - Saint Paul", "The Academy and School", "Lincoln El", "Jr & Sr High", "Pre K 12 Ctr", "A & M University", "Univ. of X (Main) Campus", "", "  ", "K 8 int school", "  the  end", "O'Neil ms shs", "a / b \\ c", "Acad. for Pcs"]


@pytest.mark.parametrize("chain", ["CEEB_SCHOOL_NAME", "NCES_SCHOOL_NAME", "CEEB_UNIVERSITY_NAME", "IPEDS_NAME"])
def test_rule_sets_as_in_sql(spark, chain):
    r = getattr(rules, chain)
    got = [x[0] for x in spark.createDataFrame([(n,) for n in NAMES], "x string").select(rewrite(F.col("x"), r)).collect()]
    con = duckdb.connect()
    con.execute("CREATE TABLE t (i INT, x VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(NAMES)))
    want = [x[0] for x in con.execute(f"SELECT {rewrite_sql('x', r)} FROM t ORDER BY i").fetchall()]
    assert got == want
    assert not any("  " in g or g != g.strip() for g in got)


def test_rewrite_null(spark):
    assert one(spark, lambda c: rewrite(c, ["lower", Rule("a", "b", True)]), None) is None


def lcs_slow(a, b):
    @lru_cache(None)
    def f(i, j):
        return 0 if i == len(a) or j == len(b) else 1 + f(i + 1, j + 1) if a[i] == b[j] else max(f(i + 1, j), f(i, j + 1))

    return f(0, 0)


def test_lcs_against_brute_force():
    rnd = random.Random(3)
    for _ in range(300):
        a, b = ("".join(rnd.choice("abc") for _ in range(rnd.randint(0, 12))) for _ in range(2))
        assert lcs_length(a, b) == lcs_slow(a, b)
        assert indel_ratio_of(a, b) == indel_ratio_of(b, a)
        assert (indel_ratio_of(a, b) == 1) == (a == b)


def test_similarities(spark):
    assert indel_ratio_of("ab", "ac") == 0.5
    assert indel_ratio_of("", "") == 1.0
    assert token_sort_ratio_of("New York City!", "city new york") == 1.0
    assert token_sort_ratio_of("--", "x") == 0.0
    d = spark.createDataFrame([("ab", "ac"), (None, "x")], "a string, b string").select(indel_ratio(F.col("a"), F.col("b")).alias("i"), token_sort_ratio(F.col("a"), F.col("b")).alias("t"))
    assert [tuple(r) for r in d.collect()] == [(0.5, 0.5), (None, None)]


@pytest.mark.parametrize("v, want", [("1234-5678", "12345678"), ("CEEB 123", "00000123"), ("5735410.0", "05735410"), (" 76250858", "76250858"), ("", None), (None, None), ("123456789", None)])
def test_digit_code(spark, v, want):
    assert one(spark, lambda c: digit_code(c, 8), v) == want


@pytest.mark.parametrize("v, want", [("02139-1234", "02139"), ("9511", "09511"), ("00000", None), ("n/a", None), ("18859 ", "18859"), ("123456", None), (None, None)])
def test_zip5(spark, v, want):
    assert one(spark, zip5, v) == want


@pytest.mark.parametrize("v, want", [("8039", "08039"), ("18015", "18015"), ("42037.0", "42037"), ("N", None), ("", None), (None, None)])
def test_county(spark, v, want):
    assert one(spark, county_code, v) == want


@pytest.mark.parametrize("v, want", [("x", True), (" N/A ", False), ("Not  available", False), ("", False), (None, False), (" ", False), ("none street", True)])
def test_usable(spark, v, want):
    assert one(spark, usable, v) is want
