"""Single operators over the star-schema tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinlink.functions.regex import Rule, replace_all, replace_first, rewrite, rewrite_sql, search
from kinlink.functions.similarity import indel_ratio, indel_ratio_sql, sorted_words_sql, token_sort_ratio, token_sort_ratio_sql
from kinlink.operators.cascade import Round, cascade, unique_join
from kinlink.operators.consolidate import earliest_non_null, latest_non_null
from kinlink.operators.pairing import potential_duplicates, two_rounds
from kinlink.operators.relational import distinct_count_over, each_column, narrowed, qualify_unique, survivorship, top_k, union_by_name, unpivoted
from kinlink.session import cut, table
from kinlink.sources.feeds import layer_table
from kinlink.sources.readers import html_tables


def _parties(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Customers and suppliers as two registries: name is the number they bear, nation and region their place."""
    place = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", F.lower("n_name").alias("city"), F.lower("r_name").alias("state"))

    def of(name: str, p: str) -> DataFrame:
        t = table(spark, d, name)
        key = {"c": "c_custkey", "s": "s_suppkey"}[p]
        number = replace_all(F.col(f"{p}_name"), r"^\w+#0*", "")
        return t.join(place, t[f"{p}_nationkey"] == place["n_nationkey"]).select(F.col(key).alias(f"{p}_id"), number.alias("name"), "city", "state", F.col(f"{p}_acctbal").alias(f"{p}_balance"))

    return of("customer", "c"), of("supplier", "s")


def exact_unique_join(spark: SparkSession, d: str) -> DataFrame:
    c, s = _parties(spark, d)
    return unique_join(c, s, Round("3", ("name", "state"))).select("strength", "c_id", "s_id", "name", "state", "c_balance", "s_balance")


ROUNDS = [Round("1", ("name", "city", "state"), partition=("city", "state")), Round("2", ("name", "city", "state")), Round("3", ("name", "state"), ("city",)), Round("4", ("name",), ("city", "state"))]


def cascade_rounds(spark: SparkSession, d: str) -> DataFrame:
    c, s = _parties(spark, d)
    return cascade(c, s, "c_id", "s_id", ROUNDS, cut).select("strength", "c_id", "s_id")


def qualify_once(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    return qualify_unique(o.select("o_orderkey", "o_custkey", "o_orderpriority"), ["o_custkey", "o_orderpriority"])


def expr_key_join(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    a = p.where("p_size <= 10").select(F.col("p_partkey").alias("a"), F.lower("p_name").alias("key"), "p_brand")
    b = p.where("p_size > 40").select(F.col("p_partkey").alias("b"), F.lower("p_name").alias("key"), "p_brand")
    return a.join(b, ["key", "p_brand"]).groupBy("key", "p_brand").agg(F.count(F.lit(1)).alias("pairs"), F.min("a").alias("least_a"), F.max("b").alias("most_b"))


def anti_pool(spark: SparkSession, d: str) -> DataFrame:
    big = table(spark, d, "orders").where("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey"))
    return narrowed(table(spark, d, "customer").select("c_custkey", "c_name"), big, "c_custkey")


def _events(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    return e.select("user_id", "event_id", F.nullif("event_type", F.lit("error")).alias("event_type"), F.when(F.col("value") > 50, F.col("value")).alias("value"), "ts")


def latest_fields(spark: SparkSession, d: str) -> DataFrame:
    return latest_non_null(_events(spark, d), "user_id", ["ts", "event_id"], ["event_type", "value"])


def earliest_fields(spark: SparkSession, d: str) -> DataFrame:
    return earliest_non_null(_events(spark, d), "user_id", ["ts", "event_id"], ["event_type", "value"])


def full_crosswalk(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").where("o_orderpriority = '1-URGENT'").groupBy(F.col("o_custkey").alias("id")).agg(F.count(F.lit(1)).alias("orders"))
    c = table(spark, d, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nation"), "c_name")
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("nation"), "n_name")
    j = o.join(c, "id", "full").join(n, "nation", "full")
    return j.select("nation", "id", "orders", "c_name", "n_name", F.when(F.col("orders").isNull(), "no-order").otherwise("ordered").alias("method"))


def survivor_fields(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.when(F.col("c_acctbal") > 0, F.col("c_name")).alias("name"), F.col("c_acctbal").alias("balance"))
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"))
    return survivorship(c, s, "id", ["name"])


def union_by_name_pad(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    return union_by_name(c, s)


def coverage_unpivot(spark: SparkSession, d: str) -> DataFrame:
    x = full_crosswalk(spark, d)
    n = x.agg(F.count_if(F.col("id").isNotNull()).alias("with_id"), F.count_if(F.col("orders").isNotNull() & F.col("c_name").isNotNull()).alias("with_both"), F.count_if(F.col("n_name").isNotNull()).alias("with_nation"))
    return unpivoted(n.select(*[F.col(c).cast("double") for c in n.columns]))


def allow_deny(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("p_type")
    return table(spark, d, "part").where(search(t, "STEEL|BRASS$|^ECONOMY") & ~search(t, r"\bBURNISHED\b|PLATED")).select("p_partkey", "p_type")


def first_and_every(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("text")
    return table(spark, d, "documents").where("text is not null").select("doc_id", F.md5(replace_first(t, r"(\d+):(\d+)", r"\2.\1")).alias("first_one"), F.md5(replace_all(t, r"(\d+):(\d+)", r"\2.\1")).alias("every_one"), F.md5(replace_first(t, r"\s+$", "")).alias("tail"))


CHAIN = ["lower", Rule(r"\.|'|,", "", True), Rule(r" the$|^the ", ""), Rule(r"o([a-z])", r"\1o"), Rule(r"\bst(\s|$)", "saint "), Rule(r"[aeiou]{2,}", "_", True), Rule(r"\s{2,}", " ", True), "trim"]


def rewriting(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", rewrite(F.concat_ws(" ", "p_name", "p_type", "p_brand"), CHAIN).alias("name"))


def tidy_fields(spark: SparkSession, d: str) -> DataFrame:
    """Stand-ins to null, padding, slices, code to bool, and a change made to all text columns of a table."""
    c = table(spark, d, "customer")
    v = each_column(c, lambda n, t: t == "string", lambda x: F.trim(F.nullif(x, F.lit("BUILDING"))))
    flag = F.when(F.col("c_nationkey") == 1, True).when(F.col("c_nationkey") == 2, False)
    return v.select("c_custkey", F.lpad(F.col("c_nationkey").cast("string"), 5, "0").alias("padded"), F.substring("c_name", 1, 5).alias("head"), F.substring("c_name", 17, 2).alias("tail"),
                    F.when(F.col("c_mktsegment").isin("MACHINERY", "FURNITURE"), None).otherwise(F.col("c_mktsegment")).alias("segment"), flag.alias("flag"))


def nested_fields(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("event_id", F.from_json("props", "struct<k:bigint>").alias("p"), F.split("event_type", "").alias("letters"))
    return e.select("event_id", F.col("p.k").alias("k"), F.posexplode("letters").alias("pos", "letter")).where("letter != ''").groupBy("letter").agg(F.count(F.lit(1)).alias("n"), F.sum("k").alias("k"), F.min("pos").alias("first_pos"))


def distinct_window(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag")
    return distinct_count_over("l_suppkey", ["l_orderkey", "l_returnflag"], li, "suppliers").select("l_orderkey", "l_linenumber", "l_returnflag", "suppliers")


def best_per_group(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    return top_k(o, ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 3).select("o_custkey", "o_orderkey", "o_totalprice")


def one_to_one_rounds(spark: SparkSession, d: str) -> DataFrame:
    c, s = _parties(spark, d)
    return two_rounds(c, s, "c_id", "s_id", [["name", "city"], ["name", "state"]])


def likely_duplicates(spark: SparkSession, d: str) -> DataFrame:
    c, s = _parties(spark, d)
    known = unique_join(c, s, Round("3", ("name", "state"))).select("c_id", "s_id")
    return potential_duplicates(c, s, cut(known), "c_id", "s_id", [["name", "city"], ["name"]])


def html_rows(spark: SparkSession, d: str) -> DataFrame:
    """Nations written as HTML tables, a page per region, and read back."""
    n = table(spark, d, "nation")
    row = F.concat(F.lit("<tr><td>"), F.col("n_nationkey").cast("string"), F.lit("</td><td> "), F.replace("n_name", F.lit("A"), F.lit("&#65;")), F.lit("</td></tr>"))
    pages = n.groupBy("n_regionkey").agg(F.concat(F.lit("<table><tr><th>Report</th></tr><tr><th>id</th><th>name</th></tr>"), F.array_join(F.array_sort(F.collect_list(row)), "\n"), F.lit("</table>")).alias("html"))
    return html_tables(pages, "n_regionkey", "html", skip=1).select("n_regionkey", F.col("cells").getItem("id").alias("id"), F.col("cells").getItem("name").alias("name"))


def similar_names(spark: SparkSession, d: str) -> DataFrame:
    """Both measures over all pairs of different part names of one first word."""
    n = table(spark, d, "part").select("p_name", F.split_part("p_name", F.lit(" "), F.lit(1)).alias("w")).distinct()
    j = n.join(n.select("w", F.col("p_name").alias("other")), "w").where("p_name < other").select("p_name", "other")
    return j.withColumn("indel", F.round(indel_ratio(F.col("p_name"), F.col("other")), 6)).withColumn("token_sort", token_sort_ratio(F.col("p_name"), F.col("other")))


def county_table(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "geography_county")
    return layer_table(g, "county").drop("geom")


def code_list(spark: SparkSession, d: str) -> DataFrame:
    """The distinct codes still to be looked up: all of one registry that another hasn't."""
    c: Column = F.col("ceeb")
    return narrowed(table(spark, d, "ceeb_school").select(c).distinct(), table(spark, d, "ncaa_school").select(F.col("ceeb_code").alias("ceeb")), "ceeb")


QUERIES = {f.__name__: f for f in (
    exact_unique_join, cascade_rounds, qualify_once, expr_key_join, anti_pool, latest_fields, earliest_fields, full_crosswalk, survivor_fields, union_by_name_pad, coverage_unpivot, allow_deny,
    first_and_every, rewriting, tidy_fields, nested_fields, distinct_window, best_per_group, one_to_one_rounds, likely_duplicates, html_rows, similar_names, county_table, code_list,
)}

_PARTIES = """place AS (SELECT n_nationkey, lower(n_name) AS city, lower(r_name) AS state FROM nation JOIN region ON n_regionkey = r_regionkey),
c AS (SELECT c_custkey AS c_id, regexp_replace(c_name, '^\\w+#0*', '', 'g') AS name, city, state, c_acctbal AS c_balance FROM customer JOIN place ON c_nationkey = n_nationkey),
s AS (SELECT s_suppkey AS s_id, regexp_replace(s_name, '^\\w+#0*', '', 'g') AS name, city, state, s_acctbal AS s_balance FROM supplier JOIN place ON s_nationkey = n_nationkey)"""


def _cascade_sql() -> str:
    out, left, right = [], "c", "s"
    for k, r in enumerate(ROUNDS, 1):
        on = " AND ".join(f"{left}.{x} = {right}.{x}" for x in r.keys)
        part = ", ".join(f"{left}.{x}" for x in (r.partition or r.keys))
        out.append(f"e{k} AS (SELECT '{r.strength}' AS strength, c_id, s_id FROM {left} JOIN {right} ON {on} QUALIFY count(*) OVER (PARTITION BY {part}) = 1)")
        out += [f"c{k} AS (SELECT * FROM {left} ANTI JOIN e{k} USING (c_id))", f"s{k} AS (SELECT * FROM {right} ANTI JOIN e{k} USING (s_id))"]
        left, right = f"c{k}", f"s{k}"
    return ", ".join(out) + " " + " UNION ALL ".join(f"SELECT * FROM e{k}" for k in range(1, len(ROUNDS) + 1))


_FULL = """SELECT nation, id, orders, c_name, n_name, CASE WHEN orders IS NULL THEN 'no-order' ELSE 'ordered' END AS method
  FROM (SELECT o_custkey AS id, count(*) AS orders FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1) o
  FULL JOIN (SELECT c_custkey AS id, c_nationkey AS nation, c_name FROM customer WHERE c_acctbal > 0) c USING (id) FULL JOIN (SELECT n_nationkey AS nation, n_name FROM nation) n USING (nation)"""
_FIELDS = "SELECT user_id, {0}(event_type, row(ts, event_id)) FILTER (WHERE event_type IS NOT NULL) AS event_type, {0}(value, row(ts, event_id)) FILTER (WHERE value IS NOT NULL) AS value FROM (SELECT user_id, event_id, nullif(event_type, 'error') AS event_type, CASE WHEN value > 50 THEN value END AS value, ts FROM events) GROUP BY user_id"
_ONE = "e{k} AS (SELECT c_id, s_id, {l}.name, {l}.{p} AS {p} FROM {l} JOIN {r} ON {l}.name = {r}.name AND {l}.{p} = {r}.{p}), g{k} AS (SELECT * FROM e{k} WHERE c_id IN (SELECT c_id FROM e{k} GROUP BY 1 HAVING count(DISTINCT s_id) = 1) AND s_id IN (SELECT s_id FROM e{k} GROUP BY 1 HAVING count(DISTINCT c_id) = 1))"
SQL = {
    "exact_unique_join": f"WITH {_PARTIES} SELECT '3) name, state' AS strength, c_id, s_id, c.name, c.state, c_balance, s_balance FROM c JOIN s ON c.name = s.name AND c.state = s.state QUALIFY count(*) OVER (PARTITION BY c.name, c.state) = 1",
    "cascade_rounds": f"WITH {_PARTIES}, {_cascade_sql()}",
    "qualify_once": "SELECT o_orderkey, o_custkey, o_orderpriority FROM orders QUALIFY count(*) OVER (PARTITION BY o_custkey, o_orderpriority) = 1",
    "expr_key_join": "SELECT lower(a.p_name) AS key, a.p_brand, count(*) AS pairs, min(a.p_partkey) AS least_a, max(b.p_partkey) AS most_b FROM part a JOIN part b ON lower(a.p_name) = lower(b.p_name) AND a.p_brand = b.p_brand WHERE a.p_size <= 10 AND b.p_size > 40 GROUP BY 1, 2",
    "anti_pool": "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)",
    "latest_fields": _FIELDS.format("arg_max"),
    "earliest_fields": _FIELDS.format("arg_min"),
    "full_crosswalk": _FULL,
    "survivor_fields": "SELECT id, coalesce(c.name, s.name) AS name, balance, nation FROM (SELECT c_custkey AS id, CASE WHEN c_acctbal > 0 THEN c_name END AS name, c_acctbal AS balance FROM customer) c FULL JOIN (SELECT s_suppkey AS id, s_name AS name, s_nationkey AS nation FROM supplier) s USING (id)",
    "union_by_name_pad": "SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer UNION ALL BY NAME SELECT s_suppkey AS id, s_name AS name, s_acctbal AS balance FROM supplier",
    "coverage_unpivot": f"WITH x AS ({_FULL}), n AS (SELECT CAST(count(id) AS DOUBLE) AS with_id, CAST(count(*) FILTER (WHERE orders IS NOT NULL AND c_name IS NOT NULL) AS DOUBLE) AS with_both, CAST(count(n_name) AS DOUBLE) AS with_nation FROM x) SELECT name, value FROM (UNPIVOT n ON COLUMNS(*))",
    "allow_deny": "SELECT p_partkey, p_type FROM part WHERE regexp_matches(p_type, 'STEEL|BRASS$|^ECONOMY') AND NOT regexp_matches(p_type, '\\bBURNISHED\\b|PLATED')",
    "first_and_every": "SELECT doc_id, md5(regexp_replace(text, '(\\d+):(\\d+)', '\\2.\\1')) AS first_one, md5(regexp_replace(text, '(\\d+):(\\d+)', '\\2.\\1', 'g')) AS every_one, md5(regexp_replace(text, '\\s+$', '')) AS tail FROM documents WHERE text IS NOT NULL",
    "rewriting": f"SELECT p_partkey, {rewrite_sql("concat_ws(' ', p_name, p_type, p_brand)", CHAIN)} AS name FROM part",
    "tidy_fields": "SELECT c_custkey, lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS padded, substr(trim(c_name), 1, 5) AS head, substr(trim(c_name), 17, 2) AS tail, CASE WHEN c_mktsegment IN ('MACHINERY', 'FURNITURE', 'BUILDING') THEN NULL ELSE trim(c_mktsegment) END AS segment, CASE c_nationkey WHEN 1 THEN true WHEN 2 THEN false END AS flag FROM customer",
    "nested_fields": "SELECT letter, count(*) AS n, sum(k) AS k, min(pos) AS first_pos FROM (SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS k, unnest(string_split(event_type, '')) AS letter, generate_subscripts(string_split(event_type, ''), 1) - 1 AS pos FROM events) GROUP BY letter",
    "distinct_window": "SELECT l_orderkey, l_linenumber, l_returnflag, count(DISTINCT l_suppkey) OVER (PARTITION BY l_orderkey, l_returnflag) AS suppliers FROM lineitem",
    "best_per_group": "SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) <= 3",
    "one_to_one_rounds": f"""WITH {_PARTIES}, {_ONE.format(k=1, l='c', r='s', p='city')}, c1 AS (SELECT * FROM c ANTI JOIN s USING (name, city)),
  s1 AS (SELECT * FROM s ANTI JOIN c USING (name, city)), {_ONE.format(k=2, l='c1', r='s1', p='state')}
  SELECT c_id, s_id, '1) name, city' AS strength FROM g1 UNION ALL SELECT c_id, s_id, '2) name, state' FROM g2""",
    "likely_duplicates": f"WITH {_PARTIES}, known AS (SELECT c_id, s_id FROM c JOIN s ON c.name = s.name AND c.state = s.state QUALIFY count(*) OVER (PARTITION BY c.name, c.state) = 1), cc AS (SELECT * FROM c ANTI JOIN known USING (c_id)), ss AS (SELECT * FROM s ANTI JOIN known USING (s_id)), d1 AS (SELECT c_id, s_id FROM cc JOIN ss USING (name, city)), d2 AS (SELECT c_id, s_id FROM (SELECT * FROM cc ANTI JOIN d1 USING (c_id)) JOIN ss USING (name)) SELECT c_id, s_id, '(potential duplicates) name, city' AS strength FROM d1 UNION ALL SELECT c_id, s_id, '(potential duplicates) name' FROM d2",
    "html_rows": "SELECT n_regionkey, CAST(n_nationkey AS VARCHAR) AS id, n_name AS name FROM nation",
    "similar_names": f"""WITH n AS (SELECT DISTINCT p_name, split_part(p_name, ' ', 1) AS w FROM part),
  j AS MATERIALIZED (SELECT n.p_name, o.p_name AS other, {sorted_words_sql('n.p_name')} AS sa, {sorted_words_sql('o.p_name')} AS sb FROM n JOIN n o ON n.w = o.w AND n.p_name < o.p_name)
  SELECT p_name, other, round({indel_ratio_sql('p_name', 'other')}, 6) AS indel, {token_sort_ratio_sql('sa', 'sb')} AS token_sort FROM j""",
    "county_table": "SELECT statefp AS state_fips, countyfp AS county_fips, geoid AS fips, namelsad AS county_name, name AS county_name_short, CAST(intptlat AS DOUBLE) AS center_latitude, CAST(intptlon AS DOUBLE) AS center_longitude, edition FROM geography_county",
    "code_list": "SELECT DISTINCT ceeb FROM ceeb_school ANTI JOIN (SELECT ceeb_code AS ceeb FROM ncaa_school) USING (ceeb)",
}
