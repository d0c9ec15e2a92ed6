"""Rows whose differently written postal addresses denote one location.

A gazetteer is built from the addresses themselves: towns of zips, spellings of streets
clustered within their locality, and at each house number the streets, directions and types
stated there. Every address is resolved by a beam search over the gazetteer's entries at its
number; rows with one identifier and number are at one location, and those with one unit besides
at one address (units don't tell locations apart).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinlink.functions.values import STAND_INS, ZIP_STAND_INS, usable, zip5
from kinlink.llm.spelling import heads
from kinlink.llm.streets import address_fields


def digest(*parts: Column) -> Column:
    """16 bytes that stand for the parts together, null parts included."""
    return F.unhex(F.md5(F.concat_ws("\x1f", *[F.coalesce(F.concat(F.lit("+"), p), F.lit("-")) for p in parts])))


def readings(rows: DataFrame) -> DataFrame:
    """rows with state, zip and town tidied, and number, direction, street, kind, unit read from the street.

    rows: state, city, zip, street and any others, which stay. zip and town are empty where none is known.
    Rows with neither a usable city nor zip drop out. number and the parts of the street are null
    where a row states no street address with a number. Whole addresses are read, whatever their
    length; only streets and cities go to Python.
    """
    zip_code = F.coalesce(zip5(F.col("zip")), F.lit(""))
    city = F.when(usable(F.col("city"), STAND_INS), F.col("city"))
    # a zip of another form counts as usable, though it names no town
    zip_told = usable(F.col("zip"), ZIP_STAND_INS)

    parts = ["town", "number", "direction", "street", "kind", "unit"]

    # not deterministic for the optimiser only: else a filter on a part is pushed below a distinct and the rows are read twice
    @F.arrow_udf(f"struct<{','.join(f'{x}:string' for x in parts)}>")
    def read(streets: pa.Array, cities: pa.Array) -> pa.Array:
        columns = zip(*map(address_fields, streets.to_pylist(), cities.to_pylist())) if len(streets) else [[]] * len(parts)
        return pa.StructArray.from_arrays([pa.array(c, pa.string()) for c in columns], parts)

    d = rows.where(zip_told | city.isNotNull())
    d = d.withColumns({"state": F.upper(F.trim(F.coalesce(F.col("state"), F.lit("")))), "city": city, "zip": zip_code})
    d = d.withColumn("_a", read.asNondeterministic()("street", "city")).drop("street", "city")
    return d.select("*", "_a.*").drop("_a")


def places_of(read: DataFrame, cut) -> DataFrame:
    """(state, zip, town, place) of rows with these and perhaps their number n: the town every row is in. It is that stated by most rows of its zip; without
    a zip of known town the stated one, misspellings put right against the state's towns."""
    named = cut(read.groupBy("state", "zip", "town").agg((F.sum("n") if "n" in read.columns else F.count(F.lit(1))).alias("n")))
    some = named.where("town != ''")
    of_zip = some.where("zip != ''").groupBy("state", "zip").agg(F.max_by("town", F.struct("n", "town")).alias("zip_town"))
    towns = some.groupBy("state", F.col("town").alias("word")).agg(F.sum("n").alias("n"))
    right = heads(towns, "state").groupBy("state", F.col("word").alias("town")).agg(F.max_by("head", F.struct("n", "head")).alias("right_town"))
    d = named.join(of_zip, ["state", "zip"], "left").join(right, ["state", "town"], "left")
    place = F.coalesce("zip_town", "right_town", F.nullif("town", F.lit("")), "zip")
    return d.select("state", "zip", "town", place.alias("place"))


def street_heads(entries: DataFrame) -> DataFrame:
    """(state, place, street, head): the spelling of each cluster of a locality's streets that stands for a misspelled one.

    entries: state, place, street, n. A spelling belongs to another of its own locality that is one edit away and
    several times as frequent in the corpus; of several the one most frequent in the locality, then in the corpus.
    Streets of other localities never replace one. A street that stands in most of its localities without the other
    is a street of its own and stays. Pairs of spellings are found once over the vocabulary, by their deletion
    neighbours, before localities are looked at.
    """
    words = entries.groupBy(F.col("street").alias("word")).agg(F.sum("n").alias("n")).withColumn("all", F.lit(0))
    near = heads(words, "all").select(F.col("word").alias("street"), "head", F.col("n").alias("corpus"))
    here = entries.select("state", "place", F.col("street").alias("head"), F.col("n").alias("here"))
    d = entries.select("state", "place", "street").join(near, "street").join(here, ["state", "place", "head"], "left")
    variant = d.groupBy("street", "head").agg(F.count(F.lit(1)).alias("places"), F.count("here").alias("beside")).where("2 * beside >= places").select("street", "head")
    d = d.where("here is not null").join(variant, ["street", "head"])
    return d.groupBy("state", "place", "street").agg(F.max_by("head", F.struct("here", "corpus", "head")).alias("head"))


BEAM = 8


def resolved(entries: list[tuple[str, str, str, str, int]], beam: int = BEAM) -> dict[tuple[str, str, str, str], str]:
    """Street identifier of each reading (street, direction, kind, zip) at one house number.

    entries: readings with their counts; those whose parts are all stated, or that nothing more
    complete explains, form the gazetteer at this number. A reading is resolved part by part by a
    beam search, first the street's name (a last word read as its type may belong to
    the name, if others state another type behind it), then its direction, then its type: a stated part must agree,
    a missing one may be filled from
    the entries, each filling weighed by the entry's count, the agreement of zips and its own plausibility;
    the beam keeps the best hypotheses. Two fillings of equal weight are no evidence: then the
    reading stands for itself.
    """
    gazetteer: dict[str, dict[tuple[str, str], dict]] = {}
    for street, direction, kind, zip_code, n in entries:
        e = gazetteer.setdefault(street, {}).setdefault((direction, kind), {"n": 0, "zips": {}})
        e["n"] += n
        if zip_code:
            e["zips"][zip_code] = e["zips"].get(zip_code, 0) + n
    out = {}
    for street, direction, kind, zip_code, _ in entries:
        if (street, direction, kind, zip_code) in out:
            continue
        step = [(0.0, street, kind)]
        if kind and street + kind in gazetteer:
            step.append((0.0, street + kind, ""))
        hypotheses = []
        for w, name, type_left in step:
            for d in sorted({d for d, _ in gazetteer[name]}):
                if d == direction:
                    hypotheses.append((w, name, type_left, d))
                elif not direction and d:
                    hypotheses.append((w + 0.5, name, type_left, d))  # a part told by others and left out here
        hypotheses = sorted(hypotheses, key=lambda h: (-h[0], h[1:]))[:beam]
        found = []
        for w, name, type_left, d in hypotheses:
            for (e_d, e_k), e in gazetteer[name].items():
                if e_d != d or (type_left and e_k != type_left) or (name != street and not e_k):
                    continue
                filled = 0.5 if e_k and not type_left else 0.0
                told = e["zips"]
                zips = 0.0 if not zip_code or not told else (1.0 if zip_code in told else -1.0)
                found.append((w + filled + zips + 0.1 * math.log1p(e["n"]), name, d, e_k))
        ranked = sorted(found, key=lambda h: (-h[0], h[1:]))[:beam]
        # as stated, unless one filling stands out from others that differ from it
        best = (0.0, street, direction, kind)
        fuller = [h for h in ranked if h[1:] != best[1:]]
        if fuller and (len(fuller) == 1 or fuller[0][0] - fuller[1][0] > 0.3 or _one_explains(fuller)):
            best = fuller[0]
        out[street, direction, kind, zip_code] = "|".join(best[1:])
    return out


def _one_explains(fuller: list[tuple[float, str, str, str]]) -> bool:
    """Whether the best filling is the others completed."""
    _, s, d, k = fuller[0]
    return all(h[1] == s and (not h[2] or h[2] == d) and (not h[3] or h[3] == k) for h in fuller[1:])


def identified(r: DataFrame, of: list[str]) -> DataFrame:
    """r's columns of, state, place, number and entry, the identifier of the street that the beam search gives.

    r: of (texts or bytes), state, place, number, street, direction, kind, zip and n, the number of rows it stands for.
    A group is the different readings at one house number of one locality whose streets begin alike, however
    many rows have them. Groups come sorted and are read as a stream; only the group at hand is kept.
    """
    keys = ["state", "place", "number", "starts"]
    columns = [*of, "street", "direction", "kind", "zip", "n"]
    k, kinds = len(of), dict(r.dtypes)
    types = [*[pa.binary() if kinds[c] == "binary" else pa.string() for c in of], *[pa.string()] * 4]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, group, out = None, [], []

        def close() -> None:
            if len({x[k : k + 3] for x in group}) > 1:
                entry = resolved([x[k:] for x in group])
                out.extend((*x[:k], *key[:3], entry[x[k : k + 4]]) for x in group)
            else:
                out.extend((*x[:k], *key[:3], "|".join(x[k : k + 3])) for x in group)

        def batch() -> pa.RecordBatch:
            done = list(zip(*out)) if out else [()] * len(types)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(done, types)], [*of, *keys[:3], "entry"])

        for t in batches:
            for row in zip(*(t.column(c).to_pylist() for c in range(len(keys) + len(columns)))):
                if row[:4] != key:
                    close()
                    key, group = row[:4], []
                group.append(row[4:])
            if len(out) > 20_000:
                yield batch()
                out.clear()
        close()
        yield batch()

    d = r.withColumn("starts", F.substring("street", 1, 1)).select(*keys, *columns)
    d = d.repartition(*keys).sortWithinPartitions(*keys)
    return d.mapInArrow(search, ", ".join([*[f"`{c}` {kinds[c]}" for c in of], *[f"{c} string" for c in (*keys[:3], "entry")]]))


ADDRESS = ("state", "city", "zip", "street")
READING = ("state", "zip", "town", "number", "direction", "street", "kind")


def read_rows(rows: DataFrame) -> DataFrame:
    """readings of rows (ADDRESS and others) with reading, a digest of all that was read but the unit: what differs
    only in case, abbreviation or the last digits of its zip has the same."""
    return readings(rows).withColumn("reading", digest(*map(F.col, READING)))


def placed(read: DataFrame, cut) -> DataFrame:
    """readings with place, the town each is in by what all of read say; see places_of."""
    return read.join(places_of(read, cut), ["state", "zip", "town"])


def located(r: DataFrame, of: list[str], cut) -> DataFrame:
    """r's columns of with state, place and location, of rows that state a street address with a number.

    r: of, state, place, number, street, direction, kind, zip and n. The gazetteer is r itself: its streets by
    locality and what is stated at each number. location is a digest of state, town, house number and street identifier.
    """
    told = r.where("number is not null")
    heads_of = street_heads(cut(told.groupBy("state", "place", "street").agg(F.sum("n").alias("n"))))
    told = told.join(heads_of, ["state", "place", "street"], "left").withColumn("street", F.coalesce("head", "street"))
    found = identified(told, of)
    return found.select(*of, "state", "place", digest(*map(F.col, ("state", "place", "number", "entry"))).alias("location"))


def gazetteer(read: DataFrame, cut) -> DataFrame:
    """(reading, state, place, location) of every different reading of read_rows' rows that states an address.

    Rows that were read the same are made one with their number first, as registries repeat themselves from
    edition to edition.
    """
    d = read.groupBy("reading", *READING).agg(F.count(F.lit(1)).alias("n"))
    return cut(located(cut(d.join(places_of(read, cut), ["state", "zip", "town"])), ["reading"], cut))


def same_location_pairs(found: DataFrame) -> DataFrame:
    """(a, b), a < b, of ids at one location: a join on the location."""
    k = found.select("id", "location").distinct()
    a, b = k.select("location", F.col("id").alias("a")), k.select("location", F.col("id").alias("b"))
    return a.join(b, "location").where("a < b").select("a", "b")


def stating(df: DataFrame, state: str, city: str, zip_col: str, street: str, **others: Column) -> DataFrame:
    """df's addresses under common names, with other columns."""
    return df.select(*[F.col(x).cast("string").alias(y) for x, y in zip((state, city, zip_col, street), ADDRESS)], *[c.alias(k) for k, c in others.items()])
