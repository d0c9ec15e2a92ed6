"""The crosswalk of colleges and universities: College Board, IPEDS and NSC codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinlink.functions.regex import rewrite, rewrite_sql, search
from kinlink.functions.rules import CEEB_UNIVERSITY_NAME, IPEDS_NAME
from kinlink.functions.similarity import best_similarities, indel_ratio_sql, sorted_words_sql, token_sort_ratio_sql
from kinlink.operators.consolidate import earliest_non_null, latest_non_null
from kinlink.operators.relational import narrowed, share, top_k, union_by_name, unpivoted
from kinlink.operators.search import BM25, bm25_top_k
from kinlink.session import cut, table

# Words of names that educational bodies bear, and of bodies that teach no one.
KEPT = ["[Uu]niversity", "College", "Institute", "Academy", "Center", "School", "Conservatory", "Seminary", "District", "Program", "Project", "Foundation", "Collegium", "Society",
        "Association", "Office", "Union", "Teach", "Committee", "Search", "Tech", "Scholars", "Agency", "MBA", "Yeshiva", "Club", "Career", "Service", "Hospital", "Education", "SUNY", "LIU"]
LEFT_OUT = ["Nav(y|al) Recruit(ing|ment) District", "Upward Bound Program", "Upward Bound", "Educational Talent Search"]
SCORE_ALONE, SCORE_LEAST, RATIO_ALONE, FUZZ_ALONE = 8.0, 4.0, 0.9, 0.95


def _blank_to_null(c: Column, *missing: str) -> Column:
    c = F.replace(c, F.lit('"'), F.lit(""))
    for m in missing:
        c = F.nullif(c, F.lit(m))
    return c


def hd_table(hd: DataFrame, states: DataFrame, order: str = "rec_id") -> DataFrame:
    """One row per IPEDS id: each field's newest value over the editions; administrative units (sector 0) and unknown sectors left out."""
    a = hd.where("sector != 0").select(
        F.col("unitid").cast("string").alias("ipeds"), _blank_to_null(F.col("opeid"), "-2", " ", "").alias("opeid"), "edition",
        F.when(F.col("f1systyp") == 1, True).when(F.col("f1systyp") == 2, False).alias("multicampus"), F.col("instnm").alias("ipeds_name"),
        F.nullif(rewrite(F.replace("instnm", F.lit('"'), F.lit("")), IPEDS_NAME), F.lit(" ")).alias("name"), _blank_to_null(F.col("addr"), " ").alias("address"),
        _blank_to_null(F.col("city"), " ").alias("city"), _blank_to_null(F.col("countynm"), " ").alias("county_name"), _blank_to_null(F.col("stabbr"), " ").alias("state_abbr"),
        F.substring("zip", 1, 5).alias("zip"), F.lpad(F.col("fips").cast("string"), 2, "0").alias("state_fips"), F.lpad(F.col("countycd").cast("string"), 5, "0").alias("fips"),
        F.col("latitude").try_cast("double").alias("latitude"), F.col("longitud").try_cast("double").alias("longitude"), F.col(order).alias("_order"),
    )
    # of an abbreviation under two names, the first in order
    s = states.where("state_abbr is not null").groupBy("state_abbr").agg(F.min("state").alias("state"))
    d = a.join(s, "state_abbr", "left")
    return latest_non_null(d, "ipeds", ["edition", "_order"], [c for c in d.columns if c not in ("ipeds", "_order")])


def ceeb_university_table(u: DataFrame) -> DataFrame:
    kept = search(F.col("name"), "|".join(KEPT)) & ~search(F.col("name"), "|".join(LEFT_OUT))
    return u.where(kept).select(F.col("ceeb_code").alias("ceeb"), F.col("name").alias("ceeb_name"), rewrite(F.col("name"), CEEB_UNIVERSITY_NAME).alias("name"), "state")


def nsc_table(nsc: DataFrame) -> DataFrame:
    """One row per IPEDS id with each field's first value by full code; rows without id become one."""
    code = F.col("nsc_college_and_branch_code")
    ipeds = F.round(F.col("ipeds_unit_id").cast("double")).cast("int").cast("string")
    a = nsc.select(F.substring(code, 1, 6).alias("nsc"), F.substring(code, 8, 2).alias("nsc_branch"), code.alias("nsc_full"), ipeds.alias("ipeds"), F.col("nsc_college_name").alias("name"))
    return earliest_non_null(a, "ipeds", ["nsc_full"])


def exact_matches(hd: DataFrame, u: DataFrame) -> DataFrame:
    """Equal lower-case names in one state; many to many."""
    right = u.select("ceeb", "ceeb_name", F.lower("name").alias("key"), F.col("state").alias("u_state"))
    left = hd.withColumn("key", F.lower("name"))
    j = left.join(right, (left.key == right.key) & (left.state == right.u_state))
    return j.select(F.lit("exact").alias("method"), "ceeb", "ipeds", "ceeb_name", "ipeds_name", "edition", "multicampus", "city", "county_name", "zip", "state", "state_abbr", "state_fips", "fips", "latitude", "longitude")


def match_quality(hd: DataFrame, u: DataFrame, exact: DataFrame) -> DataFrame:
    """(n_ipeds, n_ceeb, n_exact, quality): exact matches over the smaller table."""
    n = lambda df, c: df.agg(F.count(F.lit(1)).alias(c))
    d = n(hd, "n_ipeds").crossJoin(n(u, "n_ceeb")).crossJoin(n(exact, "n_exact"))  # three rows of one number
    return d.withColumn("quality", F.round(F.try_divide("n_exact", F.least("n_ipeds", "n_ceeb")), 6))


def unmatched(hd: DataFrame, u: DataFrame, exact: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both pools less the exact matches of bodies with several campuses or unknown ones; single-campus ones stay."""
    sure = exact.where("multicampus or multicampus is null")
    return narrowed(hd, sure, "ipeds"), narrowed(u, sure, "ceeb")


def fuzzy_matches(hd: DataFrame, u: DataFrame, exact: DataFrame, p: BM25 = BM25(), limit: int = 10) -> DataFrame:
    """The best retrieved College Board name of each IPEDS id, past thresholds on score and similarity."""
    docs, queries = unmatched(hd, u, exact)
    # a repeated row is one query, else its words would count twice
    q = queries.where("ceeb is not null").select("ceeb", F.col("name").alias("search_name"), F.col("state").alias("q_state")).distinct()
    q = cut(q.withColumn("q", F.concat_ws("\x1f", "ceeb", "search_name", "q_state")))
    hits = cut(bm25_top_k(q, "q", "search_name", docs, "ipeds", ["name", "city"], ("q_state", "state"), limit, p, cut))
    d = hits.join(q, hits["query"] == q["q"]).join(docs.select("ipeds", "name", "city", "state", "edition"), F.col("doc") == F.col("ipeds"))
    d = d.select("ipeds", F.col("score").alias("match_score"), "ceeb", "search_name", "name", "city", "state", "edition")
    d = d.withColumn("_s", best_similarities(F.col("search_name"), F.col("name"), F.col("city"))).select("*", "_s.similarity_ratio", "_s.fuzz_ratio").drop("_s")
    good = ((F.col("match_score") > SCORE_ALONE) | (F.col("similarity_ratio") > RATIO_ALONE) | (F.col("fuzz_ratio") > FUZZ_ALONE)) & (F.col("match_score") > SCORE_LEAST)
    return top_k(d.where(good), ["ipeds"], [F.desc("match_score"), F.desc("similarity_ratio"), F.asc("ceeb"), F.asc("search_name")], 1)


def university_crosswalk(hd: DataFrame, u: DataFrame, nsc: DataFrame, exact: DataFrame, fuzzy: DataFrame) -> DataFrame:
    """All ids, matched or not: full joins chained on keys that the one before coalesces."""
    m = union_by_name(fuzzy.select("ceeb", "ipeds", "state", F.lit("fuzzy").alias("method")), exact.select("ceeb", "ipeds", "state", "method"))
    j = m.join(u.select("ceeb", "ceeb_name", "state"), ["ceeb", "state"], "full").join(hd.drop("name"), ["ipeds", "state"], "full")
    j = j.join(nsc.select("ipeds", "nsc", "nsc_full", F.col("name").alias("nsc_name")), "ipeds", "full")
    return j.select(F.coalesce("method", F.lit("no-ceeb-match")).alias("method"), "ceeb", "ipeds", "nsc", "nsc_full", "ceeb_name", "ipeds_name", "nsc_name", "edition", "multicampus", "city",
                    "county_name", "zip", "state", "state_abbr", "state_fips", "fips", "latitude", "longitude")


def coverage(crosswalk: DataFrame) -> DataFrame:
    """(name, value): of six ordered pairs of id systems the percentage of the one found with the other, as text with a percent sign."""
    ids = ("ipeds", "nsc", "ceeb")
    named = {x: F.col(x).isNotNull() & F.col(f"{x}_name").isNotNull() for x in ids}
    n = crosswalk.agg(*[F.count_if(named[x]).alias(x) for x in ids], *[F.count_if(F.col(x).isNotNull() & named[y]).alias(f"{x}_{y}") for x in ids for y in ids if x != y])
    text = lambda x, y: F.concat(F.round(share(F.col(f"{y}_{x}"), F.col(x)), 6).cast("string"), F.lit("%"))
    pairs = (("ipeds", "ceeb"), ("ipeds", "nsc"), ("ceeb", "ipeds"), ("ceeb", "nsc"), ("nsc", "ipeds"), ("nsc", "ceeb"))
    return unpivoted(n.select(*[text(x, y).alias(f"{x}_by_{y}") for x, y in pairs])).where("value is not null")


def _sources(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(hd, universities, nsc) over the test tables: states from ceeb_school, and an NSC feed made of the IPEDS rows with an OPE id."""
    h = table(spark, d, "ipeds_hd")
    states = table(spark, d, "ceeb_school").select("state_abbr", "state").distinct()
    feed = h.where("length(opeid) = 8").select(F.concat(F.substring("opeid", 1, 6), F.lit("-"), F.substring("opeid", 7, 2)).alias("nsc_college_and_branch_code"), F.concat(F.col("unitid").cast("string"), F.lit(".0")).alias("ipeds_unit_id"), F.col("instnm").alias("nsc_college_name"))
    feed = feed.groupBy("nsc_college_and_branch_code", "ipeds_unit_id").agg(F.max("nsc_college_name").alias("nsc_college_name"))
    return hd_table(h, states), ceeb_university_table(table(spark, d, "ceeb_university")), nsc_table(feed)


def he_hd(spark: SparkSession, d: str) -> DataFrame:
    return _sources(spark, d)[0]


def he_universities(spark: SparkSession, d: str) -> DataFrame:
    return _sources(spark, d)[1]


def he_nsc(spark: SparkSession, d: str) -> DataFrame:
    return _sources(spark, d)[2]


def he_exact(spark: SparkSession, d: str) -> DataFrame:
    hd, u, _ = _sources(spark, d)
    return exact_matches(hd, u)


def he_quality(spark: SparkSession, d: str) -> DataFrame:
    hd, u, _ = _sources(spark, d)
    hd = cut(hd)
    return match_quality(hd, u, exact_matches(hd, u))


def he_bm25(spark: SparkSession, d: str) -> DataFrame:
    hd, u, _ = _sources(spark, d)
    hd = cut(hd)
    docs, queries = unmatched(hd, u, exact_matches(hd, u))
    q = queries.groupBy("ceeb", "name", "state").count()
    q = q.withColumn("q", F.concat_ws("|", "ceeb", "name"))
    hits = bm25_top_k(q, "q", "name", docs, "ipeds", ["name", "city"], ("state", "state"), 10, cut=cut)
    return hits.select("query", "doc", F.round("score", 6).alias("score"))


def he_fuzzy(spark: SparkSession, d: str) -> DataFrame:
    hd, u, _ = _sources(spark, d)
    hd = cut(hd)
    f = fuzzy_matches(hd, u, cut(exact_matches(hd, u)))
    return f.withColumn("match_score", F.round("match_score", 6)).withColumn("similarity_ratio", F.round("similarity_ratio", 6))


def he_crosswalk(spark: SparkSession, d: str) -> DataFrame:
    hd, u, nsc = _sources(spark, d)
    hd, u, nsc = cut(hd), cut(u), cut(nsc)
    exact = cut(exact_matches(hd, u))
    return university_crosswalk(hd, u, nsc, exact, fuzzy_matches(hd, u, exact))


def he_exact_crosswalk(spark: SparkSession, d: str) -> DataFrame:
    """The crosswalk without fuzzy matches."""
    hd, u, nsc = _sources(spark, d)
    hd = cut(hd)
    exact = exact_matches(hd, u)
    return university_crosswalk(hd, u, nsc, exact, exact.limit(0))


def he_exact_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Coverage by exact matches alone, the lower bound of the report."""
    return coverage(he_exact_crosswalk(spark, d))


def he_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Coverage of the whole crosswalk, by exact and fuzzy matches."""
    return coverage(he_crosswalk(spark, d))


QUERIES = {"he_hd": he_hd, "he_universities": he_universities, "he_nsc": he_nsc, "he_exact": he_exact, "he_quality": he_quality, "he_bm25": he_bm25, "he_fuzzy": he_fuzzy, "he_crosswalk": he_crosswalk, "he_exact_crosswalk": he_exact_crosswalk, "he_coverage": he_coverage, "he_exact_coverage": he_exact_coverage}

_FIELDS = ["opeid", "edition", "multicampus", "ipeds_name", "name", "address", "city", "county_name", "state_abbr", "zip", "state_fips", "fips", "latitude", "longitude", "state"]
_Q = "'\"'"
_HD = f"""a AS (SELECT CAST(unitid AS VARCHAR) AS ipeds, nullif(nullif(nullif(replace(opeid, {_Q}, ''), '-2'), ' '), '') AS opeid, edition,
  CASE f1systyp WHEN 1 THEN true WHEN 2 THEN false ELSE NULL END AS multicampus, instnm AS ipeds_name, nullif({rewrite_sql(f"replace(instnm, {_Q}, '')", IPEDS_NAME)}, ' ') AS name,
  nullif(replace(addr, {_Q}, ''), ' ') AS address, nullif(replace(city, {_Q}, ''), ' ') AS city, nullif(replace(countynm, {_Q}, ''), ' ') AS county_name, nullif(replace(stabbr, {_Q}, ''), ' ') AS state_abbr,
  substr(zip, 1, 5) AS zip, lpad(CAST(fips AS VARCHAR), 2, '0') AS state_fips, lpad(CAST(countycd AS VARCHAR), 5, '0') AS fips,
  TRY_CAST(latitude AS DOUBLE) AS latitude, TRY_CAST(longitud AS DOUBLE) AS longitude, rec_id FROM ipeds_hd WHERE sector != 0),
states AS (SELECT state_abbr, min(state) AS state FROM ceeb_school WHERE state_abbr IS NOT NULL GROUP BY state_abbr),
b AS (SELECT * FROM a LEFT JOIN states USING (state_abbr)),
hd AS MATERIALIZED (SELECT ipeds, {', '.join(f'arg_max({c}, row(edition, rec_id)) FILTER (WHERE {c} IS NOT NULL) AS {c}' for c in _FIELDS)} FROM b GROUP BY ipeds)"""
_U = f"""u AS MATERIALIZED (SELECT ceeb_code AS ceeb, name AS ceeb_name, {rewrite_sql('name', CEEB_UNIVERSITY_NAME)} AS name, state FROM ceeb_university
  WHERE regexp_matches(name, '{"|".join(KEPT)}') AND NOT regexp_matches(name, '{"|".join(LEFT_OUT)}'))"""
_NSC = """feed AS (SELECT substr(opeid, 1, 6) || '-' || substr(opeid, 7, 2) AS code, unitid, max(instnm) AS name FROM ipeds_hd WHERE length(opeid) = 8 GROUP BY 1, 2),
nsc AS (SELECT CAST(unitid AS VARCHAR) AS ipeds, arg_min(substr(code, 1, 6), code) AS nsc, arg_min(substr(code, 8, 2), code) AS nsc_branch, min(code) AS nsc_full,
  arg_min(name, code) FILTER (WHERE name IS NOT NULL) AS name FROM feed GROUP BY unitid)"""
_EXACT = """exact AS MATERIALIZED (SELECT 'exact' AS method, ceeb, ipeds, ceeb_name, ipeds_name, edition, multicampus, city, county_name, zip, hd.state, state_abbr, state_fips, fips, latitude, longitude
  FROM hd JOIN u ON lower(hd.name) = lower(u.name) AND hd.state = u.state)"""
_CROSSWALK = """crosswalk AS (SELECT coalesce(method, 'no-ceeb-match') AS method, ceeb, ipeds, nsc, nsc_full, ceeb_name, ipeds_name, n.name AS nsc_name, h.edition, multicampus, h.city, county_name, zip,
  state, state_abbr, state_fips, fips, latitude, longitude FROM (SELECT ceeb, ipeds, state, method FROM exact) m
  FULL JOIN (SELECT ceeb, ceeb_name, state FROM u) c USING (ceeb, state) FULL JOIN (SELECT * EXCLUDE (name) FROM hd) h USING (ipeds, state) FULL JOIN nsc n USING (ipeds))"""
_WORDS = "list_filter(string_split(regexp_replace(lower(strip_accents({})), '[^a-z]+', ' ', 'g'), ' '), lambda w: w <> '')"
_BM25 = f"""sure AS (SELECT * FROM exact WHERE multicampus OR multicampus IS NULL),
docs AS MATERIALIZED (SELECT ipeds, name, city, state FROM hd ANTI JOIN sure USING (ipeds) WHERE ipeds IS NOT NULL),
pool AS (SELECT DISTINCT ceeb, name, state FROM u ANTI JOIN sure USING (ceeb)),
w AS (SELECT ipeds, lower(state) AS block, {_WORDS.format("coalesce(name, '') || ' ' || coalesce(city, '')")} AS w FROM docs),
post AS (SELECT ipeds, block, len(w) AS length, term, count(*) AS tf FROM (SELECT ipeds, block, w, unnest(w) AS term FROM w) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM post GROUP BY term),
stats AS (SELECT (SELECT count(*) FROM docs) AS n, (SELECT sum(len(w)) FROM w) AS total),
q AS (SELECT concat_ws('|', ceeb, name) AS query, lower(state) AS block, unnest(list_distinct({_WORDS.format('name')})) AS term FROM pool),
hits AS (SELECT query, ipeds AS doc, sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length / (total / n)))) AS score
  FROM q JOIN post USING (block, term) JOIN df USING (term), stats GROUP BY 1, 2)"""
_FOUR = ("a, b", "a, b || ' ' || city", "a || ' ' || city, b", "a || ' ' || city, b || ' ' || city")
_FUZZY = f"""best AS (SELECT query, ipeds, ceeb, search_name, d.name, d.city, d.state, h.edition, score FROM (SELECT query, doc AS ipeds, score FROM hits QUALIFY row_number() OVER (PARTITION BY query ORDER BY score DESC, doc) <= 10)
  JOIN (SELECT DISTINCT concat_ws('|', ceeb, name) AS query, ceeb, name AS search_name FROM pool WHERE ceeb IS NOT NULL) USING (query) JOIN docs d USING (ipeds) JOIN (SELECT ipeds, edition FROM hd) h USING (ipeds)),
four AS MATERIALIZED ({" UNION ALL ".join(f"SELECT query, ipeds, {x.split(', ')[0]} AS x, {x.split(', ')[1]} AS y FROM (SELECT query, ipeds, search_name AS a, name AS b, city FROM best)" for x in _FOUR)}),
sorted AS MATERIALIZED (SELECT DISTINCT x, y, {sorted_words_sql('x')} AS sx, {sorted_words_sql('y')} AS sy FROM four WHERE x IS NOT NULL AND y IS NOT NULL),
measured AS MATERIALIZED (SELECT x, y, {indel_ratio_sql('x', 'y')} AS r, {token_sort_ratio_sql('sx', 'sy')} AS f FROM sorted),
ratios AS (SELECT query, ipeds, max(r) AS similarity_ratio, max(f) AS fuzz_ratio FROM four LEFT JOIN measured USING (x, y) GROUP BY query, ipeds),
fuzzy AS MATERIALIZED (SELECT ipeds, score AS match_score, ceeb, search_name, name, city, state, edition, similarity_ratio, fuzz_ratio FROM best JOIN ratios USING (query, ipeds)
  WHERE (score > {SCORE_ALONE} OR similarity_ratio > {RATIO_ALONE} OR fuzz_ratio > {FUZZ_ALONE}) AND score > {SCORE_LEAST}
  QUALIFY row_number() OVER (PARTITION BY ipeds ORDER BY score DESC, similarity_ratio DESC, ceeb, search_name) = 1)"""
_WHOLE = _CROSSWALK.replace("(SELECT ceeb, ipeds, state, method FROM exact) m", "(SELECT ceeb, ipeds, state, method FROM exact UNION ALL SELECT ceeb, ipeds, state, 'fuzzy' FROM fuzzy) m")
_PAIRS = (("ipeds", "ceeb"), ("ipeds", "nsc"), ("ceeb", "ipeds"), ("ceeb", "nsc"), ("nsc", "ipeds"), ("nsc", "ceeb"))
_COVERAGE = " UNION ALL ".join(
    f"""SELECT '{x}_by_{y}' AS name, CAST(round(round(count(*) FILTER (WHERE {y} IS NOT NULL AND {x} IS NOT NULL AND {x}_name IS NOT NULL)
  / nullif(count(*) FILTER (WHERE {x} IS NOT NULL AND {x}_name IS NOT NULL), 0), 4) * 100, 6) AS VARCHAR) || '%' AS value FROM crosswalk"""
    for x, y in _PAIRS
)
SQL = {
    "he_hd": f"WITH {_HD} SELECT * FROM hd",
    "he_universities": f"WITH {_U} SELECT * FROM u",
    "he_nsc": f"WITH {_NSC} SELECT nsc, nsc_branch, nsc_full, ipeds, name FROM nsc",
    "he_exact": f"WITH {_HD}, {_U}, {_EXACT} SELECT * FROM exact",
    "he_quality": f"WITH {_HD}, {_U}, {_EXACT}, n AS (SELECT (SELECT count(*) FROM hd) AS n_ipeds, (SELECT count(*) FROM u) AS n_ceeb, (SELECT count(*) FROM exact) AS n_exact) SELECT *, round(n_exact / least(n_ipeds, n_ceeb), 6) AS quality FROM n",
    "he_bm25": f"WITH {_HD}, {_U}, {_EXACT}, {_BM25} SELECT query, doc, round(score, 6) AS score FROM hits QUALIFY row_number() OVER (PARTITION BY query ORDER BY score DESC, doc) <= 10",
    "he_exact_crosswalk": f"WITH {_HD}, {_U}, {_NSC}, {_EXACT}, {_CROSSWALK} SELECT * FROM crosswalk",
    "he_exact_coverage": f"WITH {_HD}, {_U}, {_NSC}, {_EXACT}, {_CROSSWALK} SELECT * FROM ({_COVERAGE}) WHERE value IS NOT NULL",
    "he_fuzzy": f"""WITH {_HD}, {_U}, {_EXACT}, {_BM25}, {_FUZZY} SELECT ipeds, round(match_score, 6) AS match_score, ceeb, search_name, name, city, state, edition,
  round(similarity_ratio, 6) AS similarity_ratio, fuzz_ratio FROM fuzzy""",
    "he_crosswalk": f"WITH {_HD}, {_U}, {_NSC}, {_EXACT}, {_BM25}, {_FUZZY}, {_WHOLE} SELECT * FROM crosswalk",
    "he_coverage": f"WITH {_HD}, {_U}, {_NSC}, {_EXACT}, {_BM25}, {_FUZZY}, {_WHOLE} SELECT * FROM ({_COVERAGE}) WHERE value IS NOT NULL",
}
