"""Files whose fields are added, renamed, removed or retyped over time, read as one table."""

from __future__ import annotations

import csv
import re
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher
from itertools import combinations

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinlink.session import cut

# What stands for an absent value in these files, and the field all of them have.
ABSENT = ["", ".", "-2"]
KEY_FIELD = "unitid"
DELIMITERS = ",;\t|"


def header_name(s: str) -> str:
    return s.replace("﻿", "").replace('"', "").strip().lower()


def cells_of_line(line: str, delimiter: str) -> list[str]:
    """The fields of one line; a broken quote ends with the line."""
    csv.field_size_limit(2**31 - 1)
    try:
        return next(csv.reader([line.replace("﻿", "").rstrip("\r\n")], delimiter=delimiter, skipinitialspace=True), [])
    except csv.Error:
        return []


def header_of(line: str | None, key_field: str = KEY_FIELD) -> tuple[str, list[str]] | None:
    """(delimiter, names) if the line names key_field as one of its fields, else None."""
    if not line or key_field not in line.lower():
        return None
    for d in DELIMITERS:
        names = [header_name(x) for x in cells_of_line(line, d)]
        if key_field in names and (len(names) > 1 or not any(x in line for x in DELIMITERS)):
            return d, names
    return None


CHUNK = 10_000
BLANKS = " \t\r\n\x0b\x0c\u00a0"


def parsed(lines: DataFrame, key_field: str = KEY_FIELD) -> tuple[DataFrame, DataFrame]:
    """(files, body) from lines (series, file_name, edition, line_no, line).

    files: series, file_name, edition, nth (place in its series: by edition, then files without
    _rv first, then by name), delimiter, names. The header is the first line of a file that
    names key_field; files without one are left out. body: series, nth, line_no, names and values (trimmed; null if
    absent) of each data line, side by side, so a line stays one row. Lines before the header, comments, empty lines,
    lines without the header's number of fields and lines stored twice are no data. Only headers and lines with
    quote marks go to Python; the others are split where they are.
    """
    d = lines.select("series", "file_name", "edition", "line_no", "line").where("series is not null and file_name is not null and line is not null")

    @F.pandas_udf("struct<delimiter:string,names:array<string>>")
    def header(line: pd.Series) -> pd.DataFrame:
        h = [header_of(x, key_field) or (None, None) for x in line]
        return pd.DataFrame(h, columns=["delimiter", "names"])

    h = d.where(F.lower("line").contains(key_field)).withColumn("h", header("line")).where("h.delimiter is not null")
    h = h.groupBy("series", "file_name").agg(F.min(F.struct("line_no", "edition", "h")).alias("m"))
    h = h.select("series", "file_name", F.col("m.edition").alias("edition"), F.col("m.line_no").alias("header_no"), "m.h.delimiter", "m.h.names")
    late = F.lower("file_name").contains("_rv")
    files = cut(h.withColumn("nth", F.row_number().over(Window.partitionBy("series").orderBy("edition", late, "file_name"))))

    @F.arrow_udf("array<string>")
    def quoted(line: pa.Array, delimiter: pa.Array) -> pa.Array:
        cells = [None if a is None else cells_of_line(a, b) for a, b in zip(line.to_pylist(), delimiter.to_pylist())]
        return pa.array(cells, pa.list_(pa.string()))

    line = F.rtrim(F.replace("line", F.lit("\ufeff"), F.lit("")), F.lit("\r\n"))
    # the lines of a file stay together, of a large file CHUNK at a time, so what is aggregated per file is small after each task
    chunk = F.floor(F.col("line_no") / CHUNK).alias("chunk")
    body = d.select("series", "file_name", "line_no", "line", chunk).repartition("series", "file_name", "chunk").distinct()
    body = body.join(files, ["series", "file_name"]).where("line_no > header_no")
    plain = F.split(line, F.concat(F.lit("["), "delimiter", F.lit("]")))
    body = body.withColumn("q", quoted(F.when(F.col("line").contains('"'), F.col("line")), "delimiter")).withColumn("v", F.coalesce("q", plain))
    value = lambda x: F.when(~F.btrim(x, F.lit(BLANKS)).isin(ABSENT), F.btrim(x, F.lit(BLANKS)))
    body = body.where(F.size("v") == F.size("names")).select("series", "nth", "line_no", "names", F.transform("v", value).alias("values"))
    return files, body


def value_of(name: str | Column, names: str = "names") -> Column:
    """The value of body's field name in a line, of the first if a header has it twice; null if it has none."""
    return F.try_element_at("values", F.nullif(F.array_position(names, name), F.lit(0)).cast("int"))


def kind_code(value: Column) -> Column:
    """0 for an integer, 1 for a decimal, 2 for text, null for null: the largest of a field's values tells its kind.

    A whole number written with a point (15029.0) is no integer as written and makes the field decimal.
    """
    whole = r"^-?(0|[1-9]\d*)$"
    dotted = r"^-?(0|[1-9]\d*)?\.\d+$|^-?(0|[1-9]\d*)\.$"
    return F.when(value.rlike(whole), 0).when(value.rlike(dotted), 1).when(value.isNotNull(), 2)


KINDS = ("integer", "decimal", "text")


def content_key(value: Column) -> Column:
    """What a value says whatever its form: the digits of its number if it is one (without sign, point and
    zeros at the ends, as degrees are also stored in millionths), else its letters and digits."""
    plain = F.lower(F.trim(value))
    number = F.regexp_extract(F.replace(plain, F.lit(","), F.lit(".")), r"^[a-z]{0,2}\s*[+-]?\s*(\d+(?:\.\d+)?)\s*°?\s*[a-z]{0,2}$", 1)
    as_number = F.when(F.length(number) > 0, F.regexp_replace(F.replace(number, F.lit("."), F.lit("")), r"^0+|0+$", ""))
    return F.coalesce(as_number, F.regexp_replace(plain, r"[^\p{L}\p{N}]+", ""))


def name_likeness(a: str, b: str) -> float:
    """Likeness of field names by common letters, from 0 to 1."""
    return SequenceMatcher(None, re.sub(r"[^a-z0-9]", "", a), re.sub(r"[^a-z0-9]", "", b)).ratio()


Pair = tuple[str, str]


def flooded(a_next: dict[str, set[str]], b_next: dict[str, set[str]], start: dict[Pair, float], rounds: int = 1000, eps: float = 1e-4) -> dict[Pair, float]:
    """Similarity flooding (Melnik et al. 2002, the basic fixpoint with the start values kept).

    The pairs of nodes form the propagation graph: (x, y) feeds (x', y') where x' is beside x
    and y' beside y, a pair's score shared evenly among those it feeds. Scores are scaled by
    the largest after each round; ends when no score moves by eps. An error says so if they still do after so many rounds.
    """
    at = dict(start)
    feeds = {p: [(x, y) for x in a_next.get(p[0], ()) for y in b_next.get(p[1], ()) if (x, y) in start] for p in start}
    for _ in range(rounds):
        new = dict(start)
        for p, s in at.items():
            new[p] += s
            for q in feeds[p]:
                new[q] += s / len(feeds[p])
        top = max(new.values(), default=0) or 1.0
        new = {p: v / top for p, v in new.items()}
        if max((abs(new[p] - at[p]) for p in new), default=0) < eps:
            return new
        at = new
    raise RuntimeError(f"scores still move after {rounds} rounds")


def correspondences(old: list[dict], new: list[dict], shared: dict[Pair, tuple[int, int]], least: float = 0.6) -> list[Pair]:
    """The fields of new that carry on a field of old under another name.

    old, new: the fields of two files in order, with name, kind and n (present values). shared: of two field names how
    many units have both present, and how many of those agree in content. The schema graph of each side links
    every field to its kind, to the file (its nesting level) and to the fields beside it. Fields of one name are the
    anchors, with a start of 1; pairs of fields that went and came start from their share of common values that agree
    and a little from their names, or, without common values, from their names alone. After flooding the best pairs
    are taken one to one, the highest score first; a pair stands if its converged score is at least the share least of the
    anchors' middle one.
    """
    kept = {f["name"] for f in old} & {f["name"] for f in new}
    a, b = ([f for f in side if f["name"] not in kept] for side in (old, new))
    if not a or not b:
        return []

    def graph(side: list[dict]) -> dict[str, set[str]]:
        g: dict[str, set[str]] = {}
        for k, f in enumerate(side):
            for x in ("#file", f"#{f['kind']}", *[side[k - 1]["name"]][: k > 0]):
                g.setdefault(f["name"], set()).add(x)
                g.setdefault(x, set()).add(f["name"])
        return g

    start = {("#file", "#file"): 1.0, **{(k, k): 1.0 for k in kept}}
    start |= {(f"#{k}", f"#{m}"): 1.0 if k == m else 0.5 for k in {f["kind"] for f in old} for m in {f["kind"] for f in new}}
    pairs = [(x["name"], y["name"]) for x in a for y in b]
    for p in pairs:
        both, same = shared.get(p, (0, 0))
        start[p] = same / both + 0.1 * name_likeness(*p) if both else name_likeness(*p)
    score = flooded(graph(old), graph(new), start)
    # a file without a field of the other's names has no anchor but itself
    anchors = sorted(score[k, k] for k in kept) or [score["#file", "#file"]]
    needed = least * anchors[len(anchors) // 2]
    taken: set[Pair] = set()
    out = []
    for p in sorted(pairs, key=lambda p: (-score[p], p)):
        if score[p] >= needed and ("a", p[0]) not in taken and ("b", p[1]) not in taken:
            taken |= {("a", p[0]), ("b", p[1])}
            out.append(p)
    return out


def drift(files: DataFrame, body: DataFrame) -> DataFrame:
    """(series, nth, field, old_field, what) of every file against the one before it; files and body of parsed.

    what is kept, added, removed, renamed, and type where the kind of a kept or renamed field
    differs (fields without present values have no kind). Kinds are aggregated where the lines are. Content is compared by
    joins on the unit, and only of fields that went or came; only counts for each pair of fields reach the
    matching, which holds the fields of two files at a time. A value that occurs under several lines of a unit counts once.
    """
    cells = body.select("series", "nth", F.explode(F.arrays_zip(F.col("names").alias("name"), F.col("values").alias("value"))).alias("c"))
    kinds = cells.where("c.value is not null and c.name != ''").groupBy("series", "nth", F.col("c.name").alias("field")).agg(F.max(kind_code(F.col("c.value"))).alias("code"), F.count(F.lit(1)).alias("n"))
    kind = F.coalesce(F.element_at(F.array(*map(F.lit, KINDS)), F.col("code") + 1), F.lit("none"))
    fields = files.select("series", "nth", F.posexplode(F.array_distinct("names")).alias("pos", "field")).where("field != ''")
    fields = fields.join(kinds, ["series", "nth", "field"], "left").select("series", "nth", F.struct("pos", F.col("field").alias("name"), kind.alias("kind"), F.coalesce("n", F.lit(0)).alias("n")).alias("f"))
    per_file = fields.groupBy("series", "nth").agg(F.array_sort(F.collect_list("f")).alias("fields"))
    per_file = cut(per_file)
    prev = per_file.select("series", (F.col("nth") + 1).alias("nth"), F.col("fields").alias("old"))
    pairs = per_file.withColumnRenamed("fields", "new").join(prev, ["series", "nth"])
    names = lambda c: F.transform(c, lambda f: f["name"])
    pairs = cut(pairs.withColumn("gone", F.array_except(names("old"), names("new"))).withColumn("come", F.array_except(names("new"), names("old"))))
    both = pairs.where((F.size("gone") > 0) & (F.size("come") > 0))
    # only the cells of fields that went or came are looked up; a file is the later of one pair and the earlier of another
    both = both.withColumn("pair", F.col("nth"))
    asked = lambda side, c: F.transform(c, lambda f: F.struct("pair", F.lit(side).alias("side"), f.alias("field"))).alias("asked")
    gone = both.select("series", (F.col("pair") - 1).alias("nth"), asked("x", "gone"))
    come = both.select("series", "nth", asked("y", "come"))
    v = body.join(gone.unionByName(come).groupBy("series", "nth").agg(F.flatten(F.collect_list("asked")).alias("asked")), ["series", "nth"])
    v = v.select("series", value_of(F.lit(KEY_FIELD)).alias("unit"), "names", "values", F.explode("asked").alias("a"))
    v = v.select("series", "a.pair", "a.side", "unit", "a.field", value_of(F.col("a.field")).alias("value")).where("value is not null and unit is not null")
    v = cut(v.groupBy("series", "pair", "side", "unit", "field").agg(F.max(content_key(F.col("value"))).alias("value")))
    of = lambda x: v.where(F.col("side") == x).select("series", F.col("pair").alias("nth"), "unit", F.col("field").alias(x), F.col("value").alias(f"{x}v"))
    o, w = of("x"), of("y")
    counts = o.join(w, ["series", "nth", "unit"]).groupBy("series", "nth", "x", "y").agg(F.count(F.lit(1)).alias("both"), F.count_if(F.col("xv") == F.col("yv")).alias("same"))
    counts = counts.groupBy("series", "nth").agg(F.collect_list(F.struct("x", "y", "both", "same")).alias("shared"))
    todo = both.select("series", "nth", "old", "new").join(counts, ["series", "nth"], "left")

    def match(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for t in batches:
            rows = []
            for s, n, old, new, shared in zip(t["series"], t["nth"], t["old"], t["new"], t["shared"]):
                seen = {(x["x"], x["y"]): (x["both"], x["same"]) for x in (shared if shared is not None else ())}
                rows += [(s, n, x, y) for x, y in correspondences(list(old), list(new), seen)]
            yield pd.DataFrame(rows, columns=["series", "nth", "old_field", "field"]).astype({"nth": "int32"})

    renamed = cut(todo).mapInPandas(match, "series string, nth int, old_field string, field string")
    now = pairs.select("series", "nth", F.explode("new").alias("f")).select("series", "nth", F.col("f.name").alias("field"), F.col("f.kind").alias("kind"))
    was = pairs.select("series", "nth", F.explode("old").alias("f")).select("series", "nth", F.col("f.name").alias("link"), F.col("f.name").alias("old_field"), F.col("f.kind").alias("old_kind"))
    now = now.join(renamed, ["series", "nth", "field"], "left").select("series", "nth", "field", "kind", F.coalesce("old_field", "field").alias("link"))
    j = now.join(was, ["series", "nth", "link"], "full")
    step = F.when(F.col("old_field").isNull(), "added").when(F.col("field").isNull(), "removed").when(F.col("field") != F.col("old_field"), "renamed").otherwise("kept")
    retyped = F.when((F.col("kind") != F.col("old_kind")) & (F.col("kind") != "none") & (F.col("old_kind") != "none"), F.lit("type"))
    j = j.withColumn("what", F.explode(F.array_compact(F.array(step, retyped))))
    return j.select("series", "nth", "field", "old_field", "what")


def changes(lines: DataFrame) -> DataFrame:
    """(file_name, field, what): what of added, removed, renamed, type; see drift and parsed."""
    files, body = parsed(lines)
    d = drift(files, cut(body)).where("what != 'kept'")
    name = files.select("series", "nth", "file_name")
    return d.join(name, ["series", "nth"]).select("file_name", F.coalesce("field", "old_field").alias("field"), "what").distinct()


def chains(names: list[str], links: list) -> dict[tuple[int, str], tuple[int, str]]:
    """(nth, field) -> where its chain began, over the files of one series in order.

    names: the fields of the first file. links: (nth, field, old_field) of drift, without removed ones.
    """
    at = {x: (1, x) for x in names if x}
    out = {(1, x): r for x, r in at.items()}
    by: dict[int, dict[str, str | None]] = {}
    for x in links:
        by.setdefault(x["nth"], {})[x["field"]] = x["old_field"]
    for n in sorted(by):
        at = {f: at.get(o, (n, f)) if o else (n, f) for f, o in by[n].items()}
        out |= {(n, f): r for f, r in at.items()}
    return out


def name_counts(chain: dict[tuple[int, str], tuple[int, str]]) -> Counter:
    """Of one series: ("file", name, name) -> files with it; ("link", a, b) -> 1 if a chain bears both; ("both", a, b) -> files with both. a < b."""
    files: dict[int, set[str]] = {}
    borne: dict[tuple[int, str], set[str]] = {}
    for (n, f), r in chain.items():
        files.setdefault(n, set()).add(f)
        borne.setdefault(r, set()).add(f)
    c = Counter(("file", f, f) for fs in files.values() for f in fs)
    linked = {p for fs in borne.values() for p in combinations(sorted(fs), 2)}
    c.update(("link", *p) for p in linked)
    c.update(("both", *p) for fs in files.values() for p in combinations(sorted(fs), 2))
    return c


def name_classes(counts: dict[tuple[str, str, str], int], wanted: list[str]) -> dict[str, str]:
    """Field name -> the name it goes by in every series: a wanted one of its class, else the one most files bear.

    Names are joined from the pair that most series link on. Names that stand in more common files than
    there are series that link them mean different things, and no class holds two wanted names.
    """
    files = {a: n for (what, a, _), n in counts.items() if what == "file"}
    of = {f: {f} for f in files}
    apart = lambda a, b: (a in wanted and b in wanted) or counts.get(("both", *sorted((a, b))), 0) > counts.get(("link", *sorted((a, b))), 0)
    for n, a, b in sorted((-n, a, b) for (what, a, b), n in counts.items() if what == "link"):
        if of[a] is not of[b] and not any(apart(x, y) for x in of[a] for y in of[b]):
            both = of[a] | of[b]
            of |= dict.fromkeys(both, both)
    return {f: min(of[f], key=lambda x: (x not in wanted, -files[x], x)) for f in files}


def names_in_series(chain: dict[tuple[int, str], tuple[int, str]], classes: dict[str, str], wanted: list[str]) -> dict[tuple[int, str], str]:
    """(nth, field) -> column, over one series.

    A field called by a wanted name is that. Else its chain decides: the wanted name it bears in most of its
    files, else the class of the name it bears in most. No two fields of a file share a column: one whose
    column is another's own name or taken keeps its own name, so no value is lost.
    """
    borne: dict[tuple[int, str], Counter] = {}
    files: dict[int, list[str]] = {}
    for (n, f), r in sorted(chain.items()):
        borne.setdefault(r, Counter())[f] += 1
        files.setdefault(n, []).append(f)
    best = {r: min(c, key=lambda f: (f not in wanted, classes[f] not in wanted, -c[f], f)) for r, c in borne.items()}
    out = {}
    for n, fs in files.items():
        taken = set(fs)
        for f in fs:
            to = f if f in wanted else classes[best[chain[n, f]]]
            out[n, f] = f if to in taken else to
            taken.add(to)
    return out


def one_table(lines: DataFrame, wanted: dict[str, str]) -> DataFrame:
    """All data lines under consistent fields, whatever each file called them: every field of every file has a column.

    wanted: field -> type, the fields known beforehand. Correspondences between successive files are
    followed through each series (a fold over its files in order, as many as the longest series has), and
    what one series tells about names holds where another has a field under one name only; see
    name_classes and names_in_series. Wanted values are tidied (decimal commas, letters around numbers)
    and cast; what can't be cast is null. All other fields are text as stated. Only field names and their
    counts reach the driver, as a table's columns must.
    Columns: series, file_name, edition, line_no, unitid, wanted, then the others by name; a field named as
    one of the first four has _field after its name. Fields without a name have no column.
    """
    files, body = parsed(lines)
    body = cut(body)
    links = cut(drift(files, body)).where("what in ('kept', 'renamed', 'added')")
    per_series = links.groupBy("series").agg(F.sort_array(F.collect_list(F.struct("nth", "field", "old_field"))).alias("links"))
    folded = cut(files.where("nth = 1").select("series", "names").join(per_series, "series", "left"))
    chain_of = lambda names, links: chains(list(names), list(links) if links is not None else [])

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for t in batches:
            c: Counter = Counter()
            for names, links in zip(t["names"], t["links"]):
                c.update(name_counts(chain_of(names, links)))
            yield pd.DataFrame([(*k, v) for k, v in c.items()], columns=["what", "a", "b", "n"])

    counts = folded.mapInPandas(counted, "what string, a string, b string, n bigint").groupBy("what", "a", "b").agg(F.sum("n").alias("n"))
    classes = name_classes({(r.what, r.a, r.b): r.n for r in counts.collect()}, [KEY_FIELD, *wanted])

    def named(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for t in batches:
            rows = []
            for s, names, links in zip(t["series"], t["names"], t["links"]):
                rows += [(s, n, f, c) for (n, f), c in names_in_series(chain_of(names, links), classes, [KEY_FIELD, *wanted]).items()]
            yield pd.DataFrame(rows, columns=["series", "nth", "field", "column"]).astype({"nth": "int32"})

    column = cut(folded.mapInPandas(named, "series string, nth int, field string, column string"))
    others = sorted({r[0] for r in column.select("column").distinct().collect()} - {KEY_FIELD, *wanted})
    # where each column's value stands in the lines of a file, told once a file; a line becomes a row where it is
    to = F.map_from_entries(F.collect_list(F.struct("field", "column")))
    called = F.transform("names", lambda f: F.coalesce(F.try_element_at("to", f), F.lit("")))
    per_file = column.groupBy("series", "nth").agg(to.alias("to")).join(files, ["series", "nth"]).withColumn("called", called)
    at = F.transform(F.array(*map(F.lit, [KEY_FIELD, *wanted, *others])), lambda c: F.nullif(F.array_position("called", c), F.lit(0)).cast("int"))
    per_file = cut(per_file.select("series", "nth", "file_name", "edition", at.alias("at")))
    # numbered columns, as a field may be called as one of the others
    values = [F.try_element_at("values", F.element_at("at", i + 1)).alias(f"f{i}") for i in range(1 + len(wanted) + len(others))]
    wide = body.join(per_file, ["series", "nth"]).select("series", "file_name", "edition", "line_no", *values)

    def cast(f: str, kind: str) -> Column:
        if kind == "string":
            return F.col(f)
        num = F.regexp_extract(F.replace(F.col(f), F.lit(","), F.lit(".")), r"([+-]?\d+(?:\.\d+)?)", 1)
        west = F.when(F.lower(f).rlike(r"[ws]\s*$"), -1).otherwise(1)
        v = num.try_cast("double") * west
        return v if kind == "double" else F.round(v).try_cast(kind)

    fixed = ("series", "file_name", "edition", "line_no")
    columns = [cast(f"f{i}", wanted.get(f, "string")).alias(f"{f}_field" if f in fixed else f) for i, f in enumerate([*wanted, *others], 1)]
    return wide.select(*fixed, F.col("f0").alias(KEY_FIELD), *columns)
