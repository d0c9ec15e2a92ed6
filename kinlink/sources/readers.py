"""Readers of the files registries come in, each as a lazy DataFrame."""

from __future__ import annotations

import io
import re
import struct
import xml.etree.ElementTree as ET
import zipfile
import zlib
from collections.abc import Iterator
from functools import reduce
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def edition_of(path_column: str = "_file") -> F.Column:
    """The first four digits in a row of a file's name, as int."""
    return F.nullif(F.regexp_extract(F.regexp_extract(path_column, r"([^/]*)$", 1), r"\d{4}", 0), F.lit("")).cast("int")


def first_line(spark: SparkSession, path: str) -> str | None:
    """The first line of a file, or of the first file with one in a folder."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(conf)
    files = sorted((f.getPath() for f in fs.listStatus(at) if f.isFile()), key=lambda p: p.getName()) if fs.getFileStatus(at).isDirectory() else [at]
    for f in files:
        if f.getName()[:1] in "._":
            continue
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(f)
        stream = fs.open(f)
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
        try:
            if (line := reader.readLine()) is not None:
                return line
        finally:
            reader.close()
    return None


def csv_files(spark: SparkSession, paths: list[str], null_value: str = " ", edition: bool = True) -> DataFrame:
    """CSV files with differing headers as one table, columns aligned by name; broken rows are skipped.

    All columns stay text, as ids have leading zeros. edition is taken from each file's name. Files of one header are
    read at once, so the plan grows with the number of different headers, not of files; the driver reads their first lines.
    """
    alike: dict[str | None, list[str]] = {}
    for p in paths:
        alike.setdefault(first_line(spark, p), []).append(p)

    def of(group: list[str]) -> DataFrame:
        d = spark.read.csv(group, header=True, mode="DROPMALFORMED", nullValue=null_value, encoding="UTF-8")
        # a table written by Spark is a folder of parts, which bears the name
        name = F.regexp_extract("_metadata.file_path", r"([^/]*)(?:/part-[^/]*)?$", 1)
        return d.select("*", F.nullif(F.regexp_extract(name, r"\d{4}", 0), F.lit("")).cast("int").alias("edition")) if edition else d

    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), map(of, alike.values()))


def ndjson(spark: SparkSession, path: str, fields: list[str]) -> DataFrame:
    """A JSON object per line with the given text fields; fields a line lacks are null."""
    return spark.read.schema(", ".join(f"`{f}` string" for f in fields)).json(path)


HITS = "hits struct<hits: array<struct<_source: struct<{fields}>>>>"


def json_hits(spark: SparkSession, path: str, fields: str) -> DataFrame:
    """Search responses (arrays of objects with hits.hits._source) as a row per hit, and state from the file's name."""
    d = spark.read.option("multiLine", True).schema(HITS.format(fields=fields)).json(path)
    name = F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))
    state = F.regexp_extract(name, r"^(.*?)(\.[^.]*)?$", 1)
    return d.select(F.explode("hits.hits").alias("hit"), F.replace(state, F.lit("%20"), F.lit(" ")).alias("state")).select("hit._source.*", "state")


COLLEGE_BOARD = ("ais array<struct<ai_code: string>>, org_nces_sch_id string, org_ipeds_id string, org_full_name string, di_name string, org_short_name string, org_abbrev_name string, "
                 "org_street_addr1 string, org_city string, org_state_cd string, org_country_iso_cd string, org_zip5 string, org_geo struct<lat: double, lon: double>, last_update_dt bigint")  # fmt: skip


def college_board_schools(spark: SparkSession, path: str) -> DataFrame:
    d = json_hits(spark, path, COLLEGE_BOARD)
    return d.select(
        F.try_element_at("ais", F.lit(1))["ai_code"].alias("ceeb"), F.lpad("org_nces_sch_id", 12, "0").alias("nces"), F.col("org_ipeds_id").alias("ipeds"), F.col("org_full_name").alias("full_name"),
        F.col("di_name").alias("name"), F.col("org_short_name").alias("short_name"), F.col("org_abbrev_name").alias("abbreviated_name"), F.col("org_street_addr1").alias("address"),
        F.col("org_city").alias("city"), "state", F.col("org_state_cd").alias("state_abbr"), F.col("org_country_iso_cd").alias("country"), F.col("org_zip5").alias("zip"),
        F.col("org_geo.lat").alias("latitude"), F.col("org_geo.lon").alias("longitude"), F.timestamp_millis("last_update_dt").cast("timestamp_ntz").alias("updated"),
    )


class _Table(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows: list[list[str]] = []
        self.cell: list[str] | None = None

    def handle_starttag(self, tag, attrs):
        if tag == "tr":
            self.rows.append([])
        elif tag in ("td", "th"):
            if not self.rows:
                self.rows.append([])
            self.cell = []
            self.rows[-1].append("")
        elif tag == "br" and self.cell is not None:
            self.cell.append(" ")

    def handle_endtag(self, tag):
        if tag in ("td", "th") and self.cell is not None and self.rows and self.rows[-1]:
            self.rows[-1][-1] = "".join(self.cell).strip()
            self.cell = None

    def handle_data(self, data):
        if self.cell is not None:
            self.cell.append(data)


def table_of(page: str | None, skip: int = 0) -> list[dict[str, str]]:
    """Rows of a page's tables by the names in the first row after skip; all values text."""
    p = _Table()
    p.feed(page or "")
    p.close()
    rows = [r for r in p.rows[skip:] if r]
    return [dict(zip(rows[0], r)) for r in rows[1:]] if rows else []


def html_tables(pages: DataFrame, key: str, column: str, skip: int = 0) -> DataFrame:
    """(key, cells map<string,string>): a row per table row of each page."""
    kind = dict(pages.dtypes)[key]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for t in batches:
            rows = [(k, r) for k, page in zip(t[key], t[column]) for r in table_of(page, skip)]
            yield pd.DataFrame(rows, columns=[key, "cells"])

    return pages.select(key, column).mapInPandas(run, f"`{key}` {kind}, cells map<string,string>")


def html_files(spark: SparkSession, path: str, skip: int = 0) -> DataFrame:
    """Tables of HTML files (also those named as spreadsheets), with the file they are from."""
    t = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), "value")
    return html_tables(t, "file", "value", skip)


_SHEET = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"


def sheet_rows(data: bytes, sheet: str | None = None) -> list[list[str | None]]:
    """Cells of a sheet of an .xlsx file as text, the first sheet if none is named."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        shared = [] if "xl/sharedStrings.xml" not in z.namelist() else ["".join(t.text or "" for t in si.iter(f"{_SHEET}t")) for si in ET.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{_SHEET}si")]
        sheets = {s.get("name"): s.get(f"{_REL}id") for s in ET.fromstring(z.read("xl/workbook.xml")).iter(f"{_SHEET}sheet")}
        if sheet is not None and sheet not in sheets:
            raise ValueError(f"no sheet {sheet!r}")
        rel = {r.get("Id"): r.get("Target") for r in ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        target = rel[sheets[sheet] if sheet is not None else next(iter(sheets.values()))].lstrip("/")
        xml = ET.fromstring(z.read(target if target.startswith("xl/") else f"xl/{target}"))
    rows = []
    for row in xml.iter(f"{_SHEET}row"):
        out: list[str | None] = []
        for c in row.iter(f"{_SHEET}c"):
            letters = re.match(r"[A-Z]+", c.get("r") or "")
            at = reduce(lambda n, x: n * 26 + ord(x) - 64, letters.group(), 0) - 1 if letters else len(out)
            out += [None] * (at + 1 - len(out))
            v, kind = c.find(f"{_SHEET}v"), c.get("t")
            text = "".join(t.text or "" for t in c.iter(f"{_SHEET}t")) if kind == "inlineStr" else None if v is None else v.text
            out[at] = shared[int(text)] if kind == "s" and text is not None else text
        rows.append(out)
    return rows


def _binary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")


def xlsx_files(spark: SparkSession, path: str, sheet: str | None = None) -> DataFrame:
    """(file, row, cells map<string,string>) of spreadsheets with names in their first row."""
    def read(data: bytes):
        rows = sheet_rows(data, sheet)
        for k, r in enumerate(rows[1:], 1):
            yield k, {n: v for n, v in zip(rows[0], r) if n is not None}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for t in batches:
            rows = [(f, *r) for f, data in zip(t["file"], t["content"]) for r in read(bytes(data))]
            yield pd.DataFrame(rows, columns=["file", "row", "cells"]).astype({"row": "int32"})

    return _binary(spark, path).mapInPandas(run, "file string, row int, cells map<string,string>")


def shape_rows(data: bytes) -> list[tuple[dict[str, str], bytes | None]]:
    """Attributes and geometry (WKB) of the first shapefile in a ZIP file; points and polygons."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        at = {n.rsplit(".", 1)[-1].lower(): n for n in sorted(z.namelist(), reverse=True)}
        shp, dbf = z.read(at["shp"]), z.read(at["dbf"])
    n, head, size = struct.unpack_from("<IHH", dbf, 4)
    fields, i = [], 32
    while dbf[i] != 0x0D:
        fields.append((dbf[i : i + 11].split(b"\0")[0].decode("ascii").lower(), dbf[i + 16]))
        i += 32
    attributes = []
    for k in range(n):
        pos, row = head + k * size + 1, {}
        for name, width in fields:
            row[name] = dbf[pos : pos + width].decode("utf-8", "replace").strip()
            pos += width
        attributes.append(row)
    shapes: list[bytes | None] = []
    i = 100
    while i < len(shp):
        words = struct.unpack_from(">I", shp, i + 4)[0]
        rec, i = shp[i + 8 : i + 8 + 2 * words], i + 8 + 2 * words
        kind = struct.unpack_from("<I", rec)[0]
        if kind == 1:
            shapes.append(struct.pack("<BI2d", 1, 1, *struct.unpack_from("<2d", rec, 4)))
        elif kind == 5:
            parts, points = struct.unpack_from("<2I", rec, 36)
            starts = [*struct.unpack_from(f"<{parts}I", rec, 44), points]
            xy = struct.unpack_from(f"<{2 * points}d", rec, 44 + 4 * parts)
            rings = [xy[2 * a : 2 * b] for a, b in zip(starts, starts[1:])]
            body = b"".join(struct.pack(f"<I{len(r)}d", len(r) // 2, *r) for r in rings)
            shapes.append(struct.pack("<BII", 1, 3, len(rings)) + body)
        else:
            shapes.append(None)
    return list(zip(attributes, shapes))


def shapefiles(spark: SparkSession, path: str, edition: int) -> DataFrame:
    """(file, attributes map<string,string>, geom binary, edition) of zipped shapefiles."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for t in batches:
            rows = [(f, *r) for f, data in zip(t["file"], t["content"]) for r in shape_rows(bytes(data))]
            yield pd.DataFrame(rows, columns=["file", "attributes", "geom"])

    d = _binary(spark, path).mapInPandas(run, "file string, attributes map<string,string>, geom binary")
    return d.withColumn("edition", F.lit(edition))


def pdf_text(data: bytes, skip_pages: int = 1) -> str:
    """Text of a PDF's pages in the order of its content streams, without the first skip_pages.

    Reads plain and deflated streams with literal and hexadecimal strings, as text extracts of directories have;
    not a general PDF reader (fonts with maps of their own and object streams are not read).
    """
    pages = []
    for m in re.finditer(rb"<<(.*?)>>\s*stream\r?\n(.*?)\r?\nendstream", data, re.S):
        body = m.group(2)
        if b"FlateDecode" in m.group(1):
            try:
                body = zlib.decompress(body)
            except zlib.error:
                continue
        lines, line = [], ""
        for op in re.finditer(rb"\((?:\\.|[^\\()])*\)|<[0-9A-Fa-f\s]*>|\bT[*dDm](?!\w)|\bTJ\b|\bTj\b|\bET\b|'", body, re.S):
            x = op.group()
            if x[:1] == b"(":
                line += re.sub(r"\\(.)", r"\1", x[1:-1].decode("cp1252", "replace"))
            elif x[:1] == b"<":
                raw = bytes.fromhex(re.sub(r"\s", "", x[1:-1].decode()).ljust(2, "0"))
                line += raw[2:].decode("utf-16-be", "replace") if raw[:2] == b"\xfe\xff" else raw.decode("cp1252", "replace")
            elif x in (b"T*", b"Td", b"TD", b"Tm", b"ET", b"'") and line:
                lines.append(line)
                line = ""
        if line:
            lines.append(line)
        if lines:
            pages.append("\n".join(lines))
    return "\n".join(pages[skip_pages:])


def directory_rows(texts: DataFrame, text_col: str, states: list[str], section: str, footer: str = "", entry: str = r"(.+?)\s+(\d{4})(?=\s|$)") -> DataFrame:
    """(state, name, code) of a directory: the part behind the first section heading, cut at the states' names
    in capitals, which come in the order of states, and each part searched for entries."""
    t = F.replace(F.col(text_col), F.lit("’"), F.lit("'"))
    t = F.regexp_replace(t, footer, " ") if footer else t
    body = F.try_element_at(F.split(F.regexp_replace(t, r"\n", " "), section), F.lit(2))
    parts = texts.select(F.posexplode(F.split(body, "|".join(rf"\b{s.upper()}\b" for s in states))).alias("pos", "part")).where("pos > 0")
    found = parts.select("pos", F.explode(F.arrays_zip(F.regexp_extract_all("part", F.lit(entry), 1).alias("name"), F.regexp_extract_all("part", F.lit(entry), 2).alias("code"))).alias("e"))
    return found.select(F.try_element_at(F.array(*map(F.lit, states)), F.col("pos")).alias("state"), F.trim("e.name").alias("name"), F.col("e.code").alias("code"))


def address_parts(c: str) -> dict[str, F.Column]:
    """address, city, state and zip of "street<br>town<br>ST  - 12345"."""
    p = r"^(.*)<br>(.*)<br>(\w\w)  - (\d+)"
    return {n: F.nullif(F.regexp_extract(c, p, i), F.lit("")) for i, n in enumerate(("address", "city", "state", "zip"), 1)}


class _Cells(HTMLParser):
    """Texts of the cells of each row, the parts of one joined by <br>, and of spans of class error."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows: list[list[list[str]]] = []
        self.errors: list[str] = []
        self.into: list[str] | None = None

    def handle_starttag(self, tag, attrs):
        if tag == "tr":
            self.rows.append([])
        elif tag == "td" and self.rows:
            self.into = []
            self.rows[-1].append(self.into)
        elif tag == "span" and "error" in (dict(attrs).get("class") or "").split():
            self.into = self.errors

    def handle_endtag(self, tag):
        if tag in ("td", "span") and not (tag == "span" and self.into is not self.errors):
            self.into = None

    def handle_data(self, data):
        if self.into is not None and data.strip():
            self.into.append(data.strip())


LOOKUP = ("ncaa_code", "ceeb_code", "name", "address", "city", "state", "zip", "message")
# How the answer's rows are headed.
HEADED = {"ncaa_code": "NCAA High School Code", "ceeb_code": "CEEB Code", "name": "High School Name"}


def lookup_record(code: str, page: str | None) -> dict[str, str | None]:
    """The eight fields of an answer to a lookup by code; a failed one has the code and its message only."""
    p = _Cells()
    p.feed(page or "")
    p.close()
    told = {"<br>".join(r[0]): "<br>".join(r[1]) for r in p.rows if len(r) == 2}
    out: dict[str, str | None] = dict.fromkeys(LOOKUP)
    m = re.match(r"(.*)<br>(.*)<br>(\w\w)\s+- (\d+)", told.get("Address", ""))
    if not m:
        return out | {"ceeb_code": code, "message": " ".join(p.errors) or None}
    return out | {k: told.get(h) for k, h in HEADED.items()} | dict(zip(("address", "city", "state", "zip"), m.groups()))


def lookups(pages: DataFrame, code: str, column: str) -> DataFrame:
    """The records of answers (code, page), a row each."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for t in batches:
            yield pd.DataFrame([lookup_record(c, page) for c, page in zip(t[code], t[column])], columns=list(LOOKUP))

    return pages.select(code, column).mapInPandas(run, ", ".join(f"{c} string" for c in LOOKUP))


def state_title(name: str) -> str:
    """A state's name in capitals as it is written in text: District of Columbia."""
    return re.sub(r"\bOf\b", "of", name.title())


def register_tables(spark: SparkSession, folder: str, names: list[str], prefix: str = "") -> list[str]:
    """Temp views over the Parquet tables of a folder; gives the views' names."""
    out = []
    for n in names:
        spark.read.parquet(f"{folder}/{n}.parquet").createOrReplaceTempView(f"{prefix}{n}")
        out.append(f"{prefix}{n}")
    return out
