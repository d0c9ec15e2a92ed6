"""The crosswalk of K-12 schools: College Board codes to NCES ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinlink.functions.regex import rewrite, rewrite_sql
from kinlink.functions.rules import ADDRESS, CEEB_SCHOOL_NAME, CITY, NCES_SCHOOL_NAME
from kinlink.operators.cascade import Round, cascade
from kinlink.operators.consolidate import latest_non_null
from kinlink.operators.pairing import residual, two_rounds, unpaired
from kinlink.operators.relational import narrowed, survivorship, union_by_name
from kinlink.session import cut, table

ROUNDS = [
    Round("1", ("name", "address", "city", "state_abbr", "zip"), partition=("address", "city", "state_abbr", "zip")),
    Round("2", ("address", "city", "state_abbr", "zip"), ("name",)),
    Round("3", ("name", "city", "state_abbr", "zip"), ("address",)),
    Round("4", ("name", "city", "state_abbr"), ("address", "zip")),
    Round("5", ("name", "state_abbr", "zip"), ("address", "city")),
    Round("6", ("name", "state_abbr"), ("address", "city", "zip")),
]
MATCH_COLUMNS = ["strength", "ceeb", "nces", "name", "ceeb_name", "nces_name", "address", "city", "state_abbr", "fips", "zip", "latitude", "longitude"]


def ceeb_table(school: DataFrame, ncaa: DataFrame) -> DataFrame:
    """College Board rows, and lookups of codes it doesn't have; names, addresses and towns normalised."""
    board = school.select("ceeb", F.col("full_name").alias("ceeb_name"), "address", "city", "state_abbr", "zip", "latitude", "longitude")
    new = ncaa.where("ncaa_code is not null").select(F.col("ceeb_code").alias("ceeb"), F.col("name").alias("ceeb_name"), "address", "city", F.col("state").alias("state_abbr"), "zip")
    d = union_by_name(board, narrowed(new, board, "ceeb"))
    return d.select(
        "ceeb", "ceeb_name", rewrite(F.col("ceeb_name"), CEEB_SCHOOL_NAME).alias("name"), F.col("address").alias("ceeb_address"), rewrite(F.col("address"), ADDRESS).alias("address"),
        F.col("city").alias("ceeb_city"), rewrite(F.col("city"), CITY).alias("city"), "state_abbr", "zip", "latitude", "longitude",
    )


def nation_table(public: DataFrame, private: DataFrame | None, renamed: bool = False) -> DataFrame:
    """Public and private schools in one table. Unless renamed, private rows give only the columns named
    alike on both sides (nces, city, zip, public_private, cbsa), as the select list is the public feed's."""
    pub = public.select(
        F.col("ncessch").alias("nces"), F.col("name").alias("nces_name"), F.col("street").alias("address"), "city", F.col("state").alias("state_abbr"), F.substring("zip", 1, 5).alias("zip"),
        F.col("cnty").alias("fips"), F.col("lat").alias("latitude"), F.col("lon").alias("longitude"), F.lit("public").alias("public_private"), F.col("cd").alias("congressional_district"), "cbsa",
        F.col("sldl").alias("state_legislature_lower"), F.col("sldu").alias("state_legislature_upper"),
    )
    if private is None:
        return pub
    p = private.withColumn("nces", F.concat(F.lit("0000"), "ppin")).drop("ppin").withColumn("public_private", F.lit("private"))
    if renamed:
        for old, new in {"name": "nces_name", "street": "address", "state": "state_abbr", "cnty": "fips", "lat": "latitude", "lon": "longitude"}.items():
            p = p.withColumnRenamed(old, new) if old in p.columns else p
        p = p.withColumn("zip", F.substring("zip", 1, 5)) if "zip" in p.columns else p
    return union_by_name(pub, p.select(*[c for c in pub.columns if c in p.columns]))


def nces_table(school: DataFrame, nation: DataFrame) -> DataFrame:
    """Scraped schools over the national feed, attribute by attribute; names, addresses and towns normalised."""
    d = survivorship(school.select("nces", "state_school_id", "low_grade", "high_grade", "nces_name", "address", "city", "state_abbr", "zip", "fips", "public_private"), nation, "nces",
                     ["nces_name", "address", "city", "state_abbr", "zip", "fips", "public_private"])
    return d.select(
        "nces", "state_school_id", "nces_name", rewrite(F.col("nces_name"), NCES_SCHOOL_NAME).alias("name"), "low_grade", "high_grade", "public_private",
        F.col("address").alias("nces_address"), rewrite(F.col("address"), ADDRESS).alias("address"), F.col("city").alias("nces_city"), rewrite(F.col("city"), CITY).alias("city"),
        "state_abbr", "zip", "fips", "latitude", "longitude", "congressional_district", "cbsa", "state_legislature_lower", "state_legislature_upper",
    )


def publisher_matches(school: DataFrame) -> DataFrame:
    return school.where("nces is not null").select("ceeb", "nces")


def unique_exact_matches(ceeb: DataFrame, nces: DataFrame, told: DataFrame) -> DataFrame:
    """Six rounds over what the publisher's pairs leave; latitude and longitude are the College Board's."""
    left = narrowed(ceeb, told, "ceeb")
    right = narrowed(nces, told, "nces").withColumnRenamed("latitude", "nces_latitude").withColumnRenamed("longitude", "nces_longitude")
    return cascade(left, right, "ceeb", "nces", ROUNDS, cut).select(*MATCH_COLUMNS)


def crosswalk(ceeb: DataFrame, nces: DataFrame, told: DataFrame, matches: DataFrame) -> DataFrame:
    """Publisher's pairs and matches with the attributes of both tables, College Board's first."""
    c = ceeb.select("ceeb", "ceeb_name", "ceeb_address", "ceeb_city", *[F.col(x).alias(f"c_{x}") for x in ("state_abbr", "zip", "latitude", "longitude")])
    n = nces.select("nces", "state_school_id", "nces_name", "low_grade", "high_grade", "nces_address", "nces_city", *[F.col(x).alias(f"n_{x}") for x in ("state_abbr", "zip", "latitude", "longitude")],
                    "fips", "public_private", "congressional_district", "cbsa", "state_legislature_lower", "state_legislature_upper")
    j = union_by_name(told, matches.select("ceeb", "nces")).join(c, "ceeb", "left").join(n, "nces", "left")
    first = lambda x: F.coalesce(f"c_{x}", f"n_{x}").alias(x)
    return j.select(
        "ceeb", "nces", "state_school_id", "ceeb_name", "nces_name", "low_grade", "high_grade", F.coalesce("ceeb_address", "nces_address").alias("address"), F.coalesce("ceeb_city", "nces_city").alias("city"),
        first("state_abbr"), first("zip"), "fips", first("latitude"), first("longitude"), "public_private", "congressional_district", "cbsa", "state_legislature_lower", "state_legislature_upper",
    )


def _sources(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(ceeb, nces, told) over the test tables: all editions of nces_public consolidated, private schools taken from nces_school."""
    school = table(spark, d, "ceeb_school")
    ceeb = ceeb_table(school, table(spark, d, "ncaa_school"))
    public = latest_non_null(table(spark, d, "nces_public"), "ncessch", ["edition", "rec_id"])
    scraped = table(spark, d, "nces_school")
    private = scraped.where("public_private = 'private' and nces is not null").select(F.substring("nces", 5, 99).alias("ppin"), F.col("nces_name").alias("name"), "city", "zip")
    return ceeb, nces_table(scraped, nation_table(public, private)), publisher_matches(school)


def k12_ceeb(spark: SparkSession, d: str) -> DataFrame:
    return ceeb_table(table(spark, d, "ceeb_school"), table(spark, d, "ncaa_school"))


def k12_nces(spark: SparkSession, d: str) -> DataFrame:
    return _sources(spark, d)[1]


def k12_matches(spark: SparkSession, d: str) -> DataFrame:
    ceeb, nces, told = _sources(spark, d)
    return unique_exact_matches(ceeb, nces, told)


def k12_crosswalk(spark: SparkSession, d: str) -> DataFrame:
    ceeb, nces, told = _sources(spark, d)
    ceeb, nces = cut(ceeb), cut(nces)
    return crosswalk(ceeb, nces, told, unique_exact_matches(ceeb, nces, told))


EARLIER = [["name", "zip"], ["name", "state_abbr"]]


def _slim(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The tables' ids and the keys of the earlier matcher."""
    ceeb, nces, _ = _sources(spark, d)
    return tuple(cut(t.select(i, "name", "zip", "state_abbr")) for t, i in ((ceeb, "ceeb"), (nces, "nces")))


def k12_earlier_matches(spark: SparkSession, d: str) -> DataFrame:
    """One to one by name and zip, then by name and state."""
    return two_rounds(*_slim(spark, d), "ceeb", "nces", EARLIER).distinct()


def k12_earlier_residual(spark: SparkSession, d: str) -> DataFrame:
    """(side, code, name): what neither round of the earlier matcher has."""
    ceeb, nces = _slim(spark, d)
    m = cut(two_rounds(ceeb, nces, "ceeb", "nces", EARLIER))
    of = lambda t, i: residual(t, i, *[m.where(F.col("strength").startswith(f"{k})")) for k in (1, 2)]).select(F.lit(i).alias("side"), F.col(i).alias("code"), "name")
    return of(ceeb, "ceeb").unionByName(of(nces, "nces"))


def k12_unmatched(spark: SparkSession, d: str) -> DataFrame:
    """(side, code, name): the final pools, without the publisher's pairs, the unique exact matches and the potential duplicates by name."""
    ceeb, nces, told = _sources(spark, d)
    ceeb, nces = cut(ceeb), cut(nces)
    known = cut(union_by_name(told, unique_exact_matches(ceeb, nces, told).select("ceeb", "nces")))
    slim = lambda t, i: t.select(i, "name", "zip", "state_abbr")
    left, right = unpaired(slim(ceeb, "ceeb"), slim(nces, "nces"), known, "ceeb", "nces", EARLIER)
    of = lambda t, i: t.select(F.lit(i).alias("side"), F.col(i).alias("code"), "name")
    return of(left, "ceeb").unionByName(of(right, "nces"))


QUERIES = {
    "k12_ceeb": k12_ceeb, "k12_nces": k12_nces, "k12_matches": k12_matches, "k12_crosswalk": k12_crosswalk,
    "k12_earlier_matches": k12_earlier_matches, "k12_earlier_residual": k12_earlier_residual, "k12_unmatched": k12_unmatched,
}

_PUBLIC = ["name", "street", "city", "state", "zip", "cnty", "lat", "lon", "cd", "cbsa", "sldl", "sldu"]
_CEEB = f"""board AS (SELECT ceeb, full_name AS ceeb_name, address, city, state_abbr, zip, latitude, longitude FROM ceeb_school),
ncaa AS (SELECT ceeb_code AS ceeb, name AS ceeb_name, address, city, state AS state_abbr, zip FROM ncaa_school WHERE ncaa_code IS NOT NULL),
ceeb_all AS (SELECT * FROM board UNION ALL BY NAME SELECT * FROM ncaa ANTI JOIN board USING (ceeb)),
ceeb AS (SELECT ceeb, ceeb_name, {rewrite_sql('ceeb_name', CEEB_SCHOOL_NAME)} AS name, address AS ceeb_address, {rewrite_sql('address', ADDRESS)} AS address,
  city AS ceeb_city, lower(city) AS city, state_abbr, zip, latitude, longitude FROM ceeb_all)"""
_NCES = f"""public AS (SELECT ncessch AS nces, {', '.join(f'arg_max({c}, row(edition, rec_id)) FILTER (WHERE {c} IS NOT NULL) AS {c}' for c in _PUBLIC)} FROM nces_public GROUP BY ncessch),
nation AS (SELECT nces, name AS nces_name, street AS address, city, state AS state_abbr, substr(zip, 1, 5) AS zip, cnty AS fips, lat AS latitude, lon AS longitude, 'public' AS public_private,
  cd AS congressional_district, cbsa, sldl AS state_legislature_lower, sldu AS state_legislature_upper FROM public
  UNION ALL BY NAME SELECT '0000' || substr(nces, 5) AS nces, city, zip, 'private' AS public_private FROM nces_school WHERE public_private = 'private' AND nces IS NOT NULL),
nces_all AS (SELECT nces, state_school_id, coalesce(s.nces_name, n.nces_name) AS nces_name, coalesce(s.address, n.address) AS address, coalesce(s.city, n.city) AS city,
  coalesce(s.state_abbr, n.state_abbr) AS state_abbr, coalesce(s.zip, n.zip) AS zip, coalesce(s.fips, n.fips) AS fips, latitude, longitude, low_grade, high_grade,
  coalesce(s.public_private, n.public_private) AS public_private, congressional_district, cbsa, state_legislature_lower, state_legislature_upper
  FROM nces_school s FULL JOIN nation n USING (nces)),
nces AS (SELECT nces, state_school_id, nces_name, {rewrite_sql('nces_name', NCES_SCHOOL_NAME)} AS name, low_grade, high_grade, public_private, address AS nces_address,
  {rewrite_sql('address', ADDRESS)} AS address, city AS nces_city, lower(city) AS city, state_abbr, zip, fips, latitude, longitude, congressional_district, cbsa,
  state_legislature_lower, state_legislature_upper FROM nces_all)"""


def _rounds_sql() -> str:
    out, left, right = ["told AS MATERIALIZED (SELECT ceeb, nces FROM ceeb_school WHERE nces IS NOT NULL)", "c0 AS MATERIALIZED (SELECT * FROM ceeb ANTI JOIN told USING (ceeb))", "n0 AS MATERIALIZED (SELECT * FROM nces ANTI JOIN told USING (nces))"], "c0", "n0"
    for k, r in enumerate(ROUNDS, 1):
        part = ", ".join(f"{left}.{c}" for c in (r.partition or r.keys))
        on = " AND ".join(f"{left}.{c} = {right}.{c}" for c in r.keys)
        of = lambda c: f"{right if c in r.left_out else left}.{c}"  # noqa: B023, E731
        cols = ", ".join([f"'{r.strength}' AS strength", f"{left}.ceeb", f"{right}.nces", *[f"{of(c)} AS {c}" for c in ("name", "address", "city", "state_abbr", "zip")], f"{left}.ceeb_name", f"{right}.nces_name", f"{right}.fips", f"{left}.latitude", f"{left}.longitude"])
        out.append(f"e{k} AS MATERIALIZED (SELECT {cols} FROM {left} JOIN {right} ON {on} QUALIFY count(*) OVER (PARTITION BY {part}) = 1)")
        out += [f"c{k} AS MATERIALIZED (SELECT * FROM {left} ANTI JOIN e{k} USING (ceeb))", f"n{k} AS MATERIALIZED (SELECT * FROM {right} ANTI JOIN e{k} USING (nces))"]
        left, right = f"c{k}", f"n{k}"
    out.append("matches AS (" + " UNION ALL ".join(f"SELECT {', '.join(MATCH_COLUMNS)} FROM e{k}" for k in range(1, len(ROUNDS) + 1)) + ")")
    return ",\n".join(out)


def _earlier_round(k: int, left: str, right: str, key: str) -> str:
    """Pairs on name and key that are one to one, by windowed counts of different partners."""
    return f"""e{k} AS MATERIALIZED (SELECT * EXCLUDE (n_nces, n_ceeb) FROM (SELECT ceeb, nces, '{k}) name, {key}' AS strength,
  count(DISTINCT nces) OVER (PARTITION BY ceeb) AS n_nces, count(DISTINCT ceeb) OVER (PARTITION BY nces) AS n_ceeb
  FROM {left} JOIN {right} USING (name, {key})) WHERE n_nces = 1 AND n_ceeb = 1)"""


_EARLIER = f"""WITH {_CEEB},\n{_NCES},\n{_earlier_round(1, "ceeb", "nces", "zip")},
c1 AS MATERIALIZED (SELECT * FROM ceeb ANTI JOIN nces USING (name, zip)), n1 AS MATERIALIZED (SELECT * FROM nces ANTI JOIN ceeb USING (name, zip)),
{_earlier_round(2, "c1", "n1", "state_abbr")}, earlier AS (SELECT * FROM e2 UNION ALL BY NAME SELECT * FROM e1)
"""
_POTENTIAL = """, known AS MATERIALIZED (SELECT ceeb, nces FROM told UNION ALL SELECT ceeb, nces FROM matches),
uc AS MATERIALIZED (SELECT * FROM ceeb ANTI JOIN known USING (ceeb)), un AS MATERIALIZED (SELECT * FROM nces ANTI JOIN known USING (nces)),
d1 AS MATERIALIZED (SELECT ceeb, nces FROM uc JOIN un USING (name, zip)), uc2 AS MATERIALIZED (SELECT * FROM uc ANTI JOIN d1 USING (ceeb)),
d2 AS MATERIALIZED (SELECT ceeb, nces FROM uc2 JOIN un USING (name, state_abbr)),
found AS (SELECT * FROM known UNION ALL SELECT * FROM d1 UNION ALL SELECT * FROM d2)
"""
_POOLS = "SELECT 'ceeb' AS side, ceeb AS code, name FROM ceeb ANTI JOIN {0} USING (ceeb) UNION ALL SELECT 'nces', nces, name FROM nces ANTI JOIN {0} USING (nces)"
_ALL = f"WITH {_CEEB},\n{_NCES},\n{_rounds_sql()}\n"
SQL = {
    "k12_ceeb": f"WITH {_CEEB}\nSELECT * FROM ceeb",
    "k12_nces": f"WITH {_NCES}\nSELECT * FROM nces",
    "k12_matches": f"{_ALL}SELECT * FROM matches",
    "k12_earlier_matches": f"{_EARLIER}SELECT DISTINCT * FROM earlier",
    "k12_earlier_residual": _EARLIER + _POOLS.format("earlier"),
    "k12_unmatched": _ALL + _POTENTIAL + _POOLS.format("found"),
    "k12_crosswalk": f"""{_ALL}SELECT ceeb, nces, n.state_school_id, c.ceeb_name, n.nces_name, n.low_grade, n.high_grade, coalesce(c.ceeb_address, n.nces_address) AS address, coalesce(c.ceeb_city, n.nces_city) AS city,
  coalesce(c.state_abbr, n.state_abbr) AS state_abbr, coalesce(c.zip, n.zip) AS zip, n.fips, coalesce(c.latitude, n.latitude) AS latitude, coalesce(c.longitude, n.longitude) AS longitude, n.public_private,
  n.congressional_district, n.cbsa, n.state_legislature_lower, n.state_legislature_upper
  FROM (SELECT ceeb, nces FROM told UNION ALL SELECT ceeb, nces FROM matches) LEFT JOIN ceeb c USING (ceeb) LEFT JOIN nces n USING (nces)""",
}
