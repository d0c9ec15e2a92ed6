"""Queries pN_ of the problems tagged llm, and the SQL of those that have one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinlink.functions.values import STAND_INS, ZIP_STAND_INS, digit_code, zip5
from kinlink.llm.addresses import gazetteer, located, placed, read_rows, readings, same_location_pairs, stating
from kinlink.llm.lookalikes import canonical_texts, look_alike_pairs, look_keys
from kinlink.llm.belief import one_to_one, same_entity
from kinlink.llm.names import codes_together, name_pairs, with_name, with_places
from kinlink.llm.packing import containers
from kinlink.llm.survivors import duplicated, survivors, votes
from kinlink.llm.tokens import BYTE_BPE_50K, encoded, token_counts
from kinlink.session import cut, table

CONTAINER_TOKENS = 2048
EDITION = 2024
REGISTRY_FIELDS = {
    "ceeb_school": ["full_name", "address", "city", "zip"],
    "ncaa_school": ["name", "address", "city", "zip"],
    "nces_school": ["nces_name", "address", "city", "zip", "county_name"],
}
# Production parameters of p2_best: how far each registry is believed, and how fast a value ages.
TRUST = {"ceeb_school": 1.0, "ncaa_school": 0.8, "nces_school": 1.0}


def _registry(spark: SparkSession, d: str, name: str) -> tuple[DataFrame, dict[str, list[str]]]:
    """Rows for survivors with grp as registry and code, and the fields with their stand-ins."""
    t = table(spark, d, name)
    if name == "ceeb_school":
        code, year = digit_code(F.col("ceeb"), 8), F.year("updated")
        at: Column = F.when(year.between(2005, 2025), F.col("updated").cast("timestamp_ntz"))
    elif name == "ncaa_school":
        code, at = digit_code(F.col("ceeb_code"), 8), F.lit(None).cast("timestamp_ntz")
    else:
        code = F.concat(F.trim("state_abbr"), F.lit("-"), digit_code(F.col("state_school_id"), 7))
        at = F.lit(None).cast("timestamp_ntz")
    grp = F.when(code.isNotNull(), F.struct(F.lit(name).alias("registry"), code.alias("code")))
    fields = {f: ZIP_STAND_INS if f == "zip" else STAND_INS for f in REGISTRY_FIELDS[name]}
    return t.select(grp.alias("grp"), F.col("rec_id").alias("rec"), at.alias("at"), F.lit(TRUST[name]).alias("trust"), *fields), fields


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """The row whose value survives, for each code of several rows and field: the votes of p2_best with instant decay."""
    out = None
    for name in REGISTRY_FIELDS:
        rows, fields = _registry(spark, d, name)
        won = votes(rows.where("grp is not null"), fields, None).join(duplicated(rows), "grp")
        won = won.select("grp.registry", "grp.code", "field", F.col("rec").alias("rec_id"))
        out = won if out is None else out.unionByName(won)
    return out


# p2_best's fields and, of each registry, the field that states them.
BEST_FIELDS = ["full_name", "address", "city", "zip", "county_name"]
STATED_AS = {"ncaa_school": {"name": "full_name"}, "nces_school": {"nces_name": "full_name"}}


def p2_best(spark: SparkSession, d: str) -> DataFrame:
    """The surviving record of each code of the three registries, values weighed by trust and recency with a half-life of two years.

    system: ceeb for rows of ceeb_school and ncaa_school, which vote together on a code, and state for nces_school's.
    """
    rows = None
    for name in REGISTRY_FIELDS:
        r, _ = _registry(spark, d, name)
        system = F.lit("state" if name == "nces_school" else "ceeb")
        grp = F.when(F.col("grp").isNotNull(), F.struct(system.alias("system"), F.col("grp.code").alias("code")))
        r = r.withColumn("grp", grp).withColumnsRenamed(STATED_AS.get(name, {}))
        rows = r if rows is None else rows.unionByName(r, allowMissingColumns=True)
    fields = {f: ZIP_STAND_INS if f == "zip" else STAND_INS for f in BEST_FIELDS}
    return survivors(rows, fields).select("grp.system", "grp.code", *fields)


def _stated(spark: SparkSession, d: str) -> DataFrame:
    """Every row of the three registries: address, rec, registry, code, name and perhaps other_name; scope marks the rows p1_found asks for."""
    c, n, h = (table(spark, d, t) for t in ("ceeb_school", "nces_public", "ipeds_hd"))
    newest, rec, none = F.coalesce(F.col("edition") == EDITION, F.lit(False)), F.col("rec_id"), F.lit(None).cast("string")
    ceeb = dict(registry=F.lit("ceeb_school"), code=digit_code(F.col("ceeb"), 8), name=F.col("full_name"), other_name=F.col("name"), scope=F.lit(True))
    nces = dict(registry=F.lit("nces_public"), code=F.trim("ncessch"), name=F.col("name"), other_name=none, scope=newest)
    ipeds = dict(registry=F.lit("ipeds_hd"), code=F.col("unitid").cast("string"), name=F.col("instnm"), other_name=none, scope=newest)
    rows = stating(c, "state_abbr", "city", "zip", "address", rec=rec, **ceeb)
    rows = rows.unionByName(stating(n, "state", "city", "zip", "street", rec=rec, **nces))
    return rows.unionByName(stating(h, "stabbr", "city", "zip", "addr", rec=rec, **ipeds))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    read = cut(read_rows(_stated(spark, d).drop("registry", "code", "name", "other_name")))
    known = gazetteer(read, cut).select("reading", "location")
    found = cut(read.where("scope and rec is not null").select(F.col("rec").alias("id"), "reading").join(known, "reading").select("id", "location"))
    return same_location_pairs(found).select(F.col("a").alias("rec_a"), F.col("b").alias("rec_b"))


def p1_places(spark: SparkSession, d: str) -> DataFrame:
    """Location and unit of every row of every edition that states an address; unit is empty where none is stated."""
    read = cut(read_rows(_stated(spark, d).drop("registry", "code", "name", "other_name", "scope")))
    known = gazetteer(read, cut).select("reading", "location")
    return read.select(F.col("rec").alias("rec_id"), "reading", "unit").join(known, "reading").select("rec_id", F.hex("location").alias("location"), "unit")


def _named_codes(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(names, places) for name_pairs and with_places: registry, code, state, place and the parts of the name; registry, code, location."""
    # one row for each different statement about a code, as most editions repeat the last; nothing that is read
    # depends on case or the last digits of a zip
    rows = _stated(spark, d).where("code is not null").drop("rec", "scope")
    rows = rows.withColumns({c: F.lower(c) for c in ("city", "street", "name", "other_name")}).withColumn("zip", zip5(F.col("zip"))).distinct()
    # a name needs only the town, an address only the code: the two go their own ways, and nothing is joined back
    r = cut(placed(cut(readings(rows).drop("unit")), cut))
    names = r.select("registry", "code", "state", "place", F.explode(F.array_compact(F.array("name", "other_name"))).alias("name")).distinct()
    names = cut(with_name(names, "name").drop("name"))
    told = r.where("number is not null").groupBy("registry", "code", "state", "place", "number", "street", "direction", "kind", "zip").agg(F.count(F.lit(1)).alias("n"))
    places = cut(located(cut(told), ["registry", "code"], cut).select("registry", "code", "location").distinct())
    return names, places


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """Two codes of one registry for the same institution, by variants of its name in one town."""
    names, places = _named_codes(spark, d)
    # ipeds_hd's institutions and the schools meet in one call, but only pairs of one registry are asked for
    apart = names.withColumn("state", F.concat_ws("/", "registry", "state"))
    return codes_together(cut(with_places(name_pairs(apart, cut), places)), names, cut)


# The states' names as ceeb_university writes them, with their postal abbreviations.
STATES = {
    "Alabama": "AL", "Alaska": "AK", "Arizona": "AZ", "Arkansas": "AR", "California": "CA", "Colorado": "CO", "Connecticut": "CT", "Delaware": "DE", "District of Columbia": "DC",
    "Florida": "FL", "Georgia": "GA", "Hawaii": "HI", "Idaho": "ID", "Illinois": "IL", "Indiana": "IN", "Iowa": "IA", "Kansas": "KS", "Kentucky": "KY", "Louisiana": "LA", "Maine": "ME",
    "Maryland": "MD", "Massachusetts": "MA", "Michigan": "MI", "Minnesota": "MN", "Mississippi": "MS", "Missouri": "MO", "Montana": "MT", "Nebraska": "NE", "Nevada": "NV",
    "New Hampshire": "NH", "New Jersey": "NJ", "New Mexico": "NM", "New York": "NY", "North Carolina": "NC", "North Dakota": "ND", "Ohio": "OH", "Oklahoma": "OK", "Oregon": "OR",
    "Pennsylvania": "PA", "Rhode Island": "RI", "South Carolina": "SC", "South Dakota": "SD", "Tennessee": "TN", "Texas": "TX", "Utah": "UT", "Vermont": "VT", "Virginia": "VA",
    "Washington": "WA", "West Virginia": "WV", "Wisconsin": "WI", "Wyoming": "WY",
}


def _universities(spark: SparkSession, d: str) -> DataFrame:
    """Names of ceeb_university as _named_codes gives them; the registry states no place but the state."""
    states = F.create_map(*[F.lit(x) for kv in STATES.items() for x in kv])
    code = F.coalesce(digit_code(F.col("ceeb_code"), 7), F.trim("ceeb_code"))
    u = table(spark, d, "ceeb_university").select(F.lit("ceeb_university").alias("registry"), code.alias("code"), F.try_element_at(states, F.trim("state")).alias("state"), F.lit("").alias("place"), "name")
    return with_name(u, "name").drop("name")


def _school_evidence(spark: SparkSession, d: str, pairs: DataFrame, names: DataFrame) -> DataFrame:
    """(kind, a, b, odds) of College Board and NCES codes: by names, places and what the publisher says."""
    told = table(spark, d, "ceeb_school").select(digit_code(F.col("ceeb"), 8).alias("a"), digit_code(F.col("nces"), 12).alias("b")).where("a is not null and b is not null").distinct()
    told = told.join(names.where("registry = 'nces_public'").select(F.col("code").alias("b")).distinct(), "b", "left_semi")
    named = pairs.where("registry_a = 'ceeb_school' and registry_b = 'nces_public'").select(F.col("code_a").alias("a"), F.col("code_b").alias("b"), "agree", "together")
    k12 = named.join(told.withColumn("told", F.lit(True)), ["a", "b"], "full").join(told.select("a", F.lit(True).alias("has")).distinct(), "a", "left")
    odds = 4.0 * F.coalesce("agree", F.lit(0.0)) - F.when(F.col("agree").isNull(), 2.0).otherwise(1.5)
    odds = odds + F.when(F.col("together"), 3.0).when(~F.col("together"), -2.0).otherwise(0.0)
    odds = odds + F.when(F.col("told"), 2.5).when(F.col("has"), -1.0).otherwise(0.0)
    return k12.select(F.lit("k12").alias("kind"), "a", "b", odds.alias("odds"))


def _nodes(node: DataFrame, registries: tuple[str, str]) -> DataFrame:
    """(kind, code, entity) of same_entity's rows of a registry of schools and one of colleges."""
    return node.where(F.col("registry").isin(*registries)).select(F.when(F.col("registry") == registries[0], "k12").otherwise("he").alias("kind"), "code", "entity")


def p4_matches(spark: SparkSession, d: str) -> DataFrame:
    """(code, match_id, confidence): marginal match probabilities of schools and colleges without a common key.

    Evidence of a candidate pair as log odds: how well the names agree, whether the places do, and what
    the publisher says. Codes of one institution within a registry are one node; where a registry states no
    places (ceeb_university), codes of one state whose names agree fully are, or in part if the names are theirs alone.
    """
    names, places = _named_codes(spark, d)
    colleges = names.where("registry = 'ipeds_hd'")
    # schools meet schools and colleges meet colleges, in one call
    apart = names.withColumn("state", F.when(F.col("registry") == "ipeds_hd", F.concat(F.lit("u/"), "state")).otherwise(F.col("state")))
    pairs = cut(with_places(name_pairs(apart, cut), places))
    u = cut(_universities(spark, d).where("state is not null"))
    he = name_pairs(cut(u.unionByName(colleges.where("state is not null"))), cut, by_town=False)
    same = codes_together(he.where("registry_b = 'ceeb_university'").withColumn("together", F.lit(None).cast("boolean")), u, cut)
    node = cut(same_entity(codes_together(pairs, names, cut).unionByName(same), cut))
    he = he.where("registry_a = 'ceeb_university' and registry_b = 'ipeds_hd'").select(F.lit("he").alias("kind"), F.col("code_a").alias("a"), F.col("code_b").alias("b"), (6.0 * F.col("agree") - 3.0).alias("odds"))
    e = _school_evidence(spark, d, pairs, names).unionByName(he)
    # a code's node: its entity, else itself
    for x, side, registries in (("a", "l", ("ceeb_school", "ceeb_university")), ("b", "r", ("nces_public", "ipeds_hd"))):
        of = _nodes(node, registries).select("kind", F.col("code").alias(x), F.col("entity").alias("_of"))
        e = e.join(of, ["kind", x], "left").withColumn(side, F.concat_ws("|", "kind", F.coalesce("_of", x))).drop("_of")
    e = cut(e)
    won = one_to_one(e.groupBy("l", "r").agg(F.max("odds").alias("odds")), cut).where("p >= 0.5")
    # every code of a matched node belongs to the match
    left = e.select("l", "a").unionByName(_nodes(node, ("ceeb_school", "ceeb_university")).select(F.concat_ws("|", "kind", "entity").alias("l"), F.col("code").alias("a"))).distinct()
    right = e.select("r", "b").unionByName(_nodes(node, ("nces_public", "ipeds_hd")).select(F.concat_ws("|", "kind", "entity").alias("r"), F.col("code").alias("b"))).distinct()
    return won.join(left, "l").join(right, "r").select(F.col("a").alias("code"), F.col("b").alias("match_id"), F.round("p", 6).alias("confidence"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return p4_matches(spark, d).select("code", "match_id").distinct()


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return encoded(table(spark, d, "documents"), "doc_id", "text", BYTE_BPE_50K)


def p9_containers(spark: SparkSession, d: str) -> DataFrame:
    sizes = token_counts(table(spark, d, "documents"), "doc_id", "text", BYTE_BPE_50K)
    return containers(sizes, "doc_id", "n_tokens", CONTAINER_TOKENS, cut)


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    keys = cut(look_keys(table(spark, d, "documents"), "doc_id", "text", cut))
    return look_alike_pairs(keys).select(F.col("a").alias("doc_a"), F.col("b").alias("doc_b"))


def p10_texts(spark: SparkSession, d: str) -> DataFrame:
    return canonical_texts(table(spark, d, "documents"), "doc_id", "text", cut)


QUERIES = {"p1_found": p1_found, "p1_places": p1_places, "p2_found": p2_found, "p2_best": p2_best, "p4_found": p4_found, "p4_matches": p4_matches, "p7_found": p7_found, "p8_ids": p8_ids, "p9_containers": p9_containers, "p10_found": p10_found, "p10_texts": p10_texts}

_STAND_INS = ", ".join(f"'{s}'" for s in STAND_INS)


def _p2_sql(name: str, code: str, at: str) -> str:
    long = " UNION ALL ".join(
        f"SELECT {code} AS code, '{f}' AS field, rec_id, {at} AS seen, {f} AS v FROM {name}" for f in REGISTRY_FIELDS[name]
    )
    return f"""SELECT '{name}' AS registry, code, field, arg_max(rec_id, row(seen, rec_id)) AS rec_id FROM ({long})
  WHERE v IS NOT NULL AND lower(trim(v)) NOT IN ({_STAND_INS}) AND NOT (field = 'zip' AND trim(v) = '00000')
    AND code IN (SELECT {code} FROM {name} GROUP BY 1 HAVING count(*) >= 2)
  GROUP BY code, field"""


def _digits(c: str, n: int) -> str:
    return f"lpad(nullif(regexp_replace(regexp_replace(trim({c}), '[.]0+$', ''), '[^0-9]', '', 'g'), ''), {n}, '0')"


_OLDEST = "TIMESTAMP '0001-01-01'"
SQL = {
    "p2_found": " UNION ALL ".join([
        _p2_sql("ceeb_school", _digits("ceeb", 8), f"CASE WHEN year(updated) BETWEEN 2005 AND 2025 THEN updated ELSE {_OLDEST} END"),
        _p2_sql("ncaa_school", _digits("ceeb_code", 8), _OLDEST),
        _p2_sql("nces_school", f"(trim(state_abbr) || '-' || {_digits('state_school_id', 7)})", _OLDEST),
    ])
}
