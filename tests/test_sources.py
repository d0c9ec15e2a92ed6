import io
import os
import struct
import zipfile
import zlib

import pytest
from pyspark.sql import functions as F

from kinlink.sources import catalog, landing, readers, sinks
from kinlink.streaming.editions import append_editions


def test_csv_files_align_by_name(spark, tmp_path):
    (tmp_path / "hd2009.csv").write_text('unitid,name\n01,"a, b"\n02, \n')
    (tmp_path / "hd2010.csv").write_text("name,sector,unitid\nc,1,03\n")
    d = readers.csv_files(spark, [str(tmp_path / "hd2009.csv"), str(tmp_path / "hd2010.csv")])
    assert sorted(map(tuple, d.select("unitid", "name", "edition", "sector").collect())) == [("01", "a, b", 2009, None), ("02", None, 2009, None), ("03", "c", 2010, "1")]


def test_json(spark, tmp_path):
    (tmp_path / "New%20York.json").write_text('[{"hits":{"hits":[{"_source":{"ais":[{"ai_code":"012345"}],"org_nces_sch_id":"36","org_geo":{"lat":40.5,"lon":-73.5},"last_update_dt":86400000}},{"_source":{"org_full_name":"X"}}]}}]')
    r = readers.college_board_schools(spark, str(tmp_path)).orderBy("ceeb").collect()
    assert (r[1].ceeb, r[1].nces, r[1].state, r[1].latitude, str(r[1].updated)) == ("012345", "000000000036", "New York", 40.5, "1970-01-02 00:00:00")
    assert (r[0].ceeb, r[0].full_name) == (None, "X")
    (tmp_path / "n").mkdir()
    (tmp_path / "n/a.json").write_text('{"ncaa_code": "1", "message": "m"}\n{"name": "n"}\n')
    assert sorted(map(str, readers.ndjson(spark, str(tmp_path / "n"), ["ncaa_code", "name", "message"]).collect()))[0] == "Row(ncaa_code='1', name=None, message='m')"


def test_html(spark, tmp_path):
    page = "<html><table><tr><td>Title</td></tr><tr><th>id</th><th>na&amp;me</th></tr><tr><td>01</td><td>a<br>b</td></tr><tr><td>02</td></tr></table></html>"
    (tmp_path / "x.xls").write_text(page)
    got = readers.html_files(spark, str(tmp_path / "x.xls"), skip=1).select("cells").collect()
    assert [r.cells for r in got] == [{"id": "01", "na&me": "a b"}, {"id": "02"}]
    assert readers.table_of(None) == [] and readers.table_of("") == []


def xlsx(rows):
    s = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    cells = lambda k, r: "".join(f'<c r="{"ABC"[i]}{k}" t="inlineStr"><is><t>{v}</t></is></c>' for i, v in enumerate(r) if v is not None)
    b = io.BytesIO()
    with zipfile.ZipFile(b, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{s}" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="One" sheetId="1" r:id="rId1"/><sheet name="Two" sheetId="2" r:id="rId2"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="rId1" Target="worksheets/sheet1.xml"/><Relationship Id="rId2" Target="worksheets/sheet2.xml"/></Relationships>')
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{s}"><sheetData>' + "".join(f"<row>{cells(k, r)}</row>" for k, r in enumerate(rows, 1)) + "</sheetData></worksheet>")
        z.writestr("xl/worksheets/sheet2.xml", f'<worksheet xmlns="{s}"><sheetData><row><c r="A1" t="s"><v>0</v></c></row><row><c r="A2"><v>7</v></c></row></sheetData></worksheet>')
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{s}"><si><r><t>he</t></r><r><t>ad</t></r></si></sst>')
    return b.getvalue()


def test_xlsx(spark, tmp_path):
    (tmp_path / "a.xlsx").write_bytes(xlsx([["id", "name", "z"], ["01", None, "q"]]))
    assert [(r.file, r.row, r.cells) for r in readers.xlsx_files(spark, str(tmp_path)).collect()] == [("a.xlsx", 1, {"id": "01", "name": None, "z": "q"})]
    assert [r.cells for r in readers.xlsx_files(spark, str(tmp_path), "Two").collect()] == [{"head": "7"}]
    with pytest.raises(ValueError):
        readers.sheet_rows((tmp_path / "a.xlsx").read_bytes(), "None")


def shape_zip():
    ring = [(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (0.0, 0.0)]
    poly = struct.pack("<I4d2I1I", 5, 0, 0, 1, 1, 1, len(ring), 0) + b"".join(struct.pack("<2d", *p) for p in ring)
    point = struct.pack("<I2d", 1, 5.0, 6.0)
    shp = b"\0" * 100 + b"".join(struct.pack(">2I", k, len(r) // 2) + r for k, r in enumerate((poly, point), 1))
    field = b"NAME".ljust(11, b"\0") + b"C" + b"\0" * 4 + bytes([6, 0]) + b"\0" * 14
    dbf = struct.pack("<4BIHH20x", 3, 24, 1, 1, 2, 32 + 32 + 1, 7) + field + b"\x0d" + b" " + b"Alpha " + b" " + b"Beta  "
    b = io.BytesIO()
    with zipfile.ZipFile(b, "w") as z:
        z.writestr("t.shp", shp)
        z.writestr("t.dbf", dbf)
    return b.getvalue()


def test_shapefile(spark, tmp_path):
    (tmp_path / "t.zip").write_bytes(shape_zip())
    from kinlink.operators.nearby import wkb_edges

    got = readers.shapefiles(spark, str(tmp_path), 2024).collect()
    assert [(r.attributes, r.edition) for r in got] == [({"name": "Alpha"}, 2024), ({"name": "Beta"}, 2024)]
    assert wkb_edges(bytes(got[0].geom)) == [(0.0, 0.0, 0.0, 1.0), (0.0, 1.0, 1.0, 1.0), (1.0, 1.0, 0.0, 0.0)]


def test_pdf_and_directory(spark):
    stream = lambda t: zlib.compress("\n".join(f"({x}) Tj T*" for x in t).encode())
    page = lambda t: b"<< /Filter /FlateDecode >> stream\n" + stream(t) + b"\nendstream "
    pdf = page(["Cover"]) + page(["Preface", "COLLEGES", "ALABAMA", "Alpha College 1001", "Beta \\(U\\) 1002", "ALASKA", "Gamma 1003", "Page 2"])
    text = readers.pdf_text(pdf)
    assert "Cover" not in text and "Beta (U) 1002" in text
    d = readers.directory_rows(spark.createDataFrame([(text,)], "t string"), "t", ["Alabama", "Alaska"], "COLLEGES", r"Page \d+")
    assert sorted(map(tuple, d.collect())) == [("Alabama", "Alpha College", "1001"), ("Alabama", "Beta (U)", "1002"), ("Alaska", "Gamma", "1003")]


def test_address_parts(spark):
    d = spark.createDataFrame([("1 A St<br>Town<br>NY  - 01234",), ("x",)], "a string").select(*[c.alias(n) for n, c in readers.address_parts("a").items()])
    assert [tuple(r) for r in d.collect()] == [("1 A St", "Town", "NY", "01234"), (None,) * 4]


def test_sinks(spark, tmp_path):
    p = str(tmp_path / "t")
    d = spark.createDataFrame([(1, 2023), (2, 2024)], "v int, edition int")
    sinks.append_edition(d, p, ["edition"])
    sinks.append_edition(d.unionByName(spark.createDataFrame([(3, 2025)], d.schema)), p, ["edition"])
    assert sorted(map(tuple, spark.read.parquet(p).select("v", "edition").collect())) == [(1, 2023), (2, 2024), (3, 2025)]
    sinks.replace_editions(spark.createDataFrame([(9, 2024)], d.schema), p, ["edition"])
    assert sorted(r.v for r in spark.read.parquet(p).collect()) == [1, 3, 9]
    assert not sinks.create_if_absent(d, p) and sinks.create_if_absent(d, p + "2")
    sinks.export_csv(d, p + "c", ["v"])
    assert [x for f in sorted(os.listdir(p + "c")) if f.endswith(".csv") for x in open(f"{p}c/{f}")] == ["v,edition\n", "1,2023\n", "2,2024\n"]
    sinks.export_ndjson(d, p + "j", ["v"])
    assert spark.read.json(p + "j").count() == 2


def test_catalog_and_landing(spark, tmp_path):
    spark.range(1).write.parquet(str(tmp_path / "a.parquet"))
    assert readers.register_tables(spark, str(tmp_path), ["a"], "x_") == ["x_a"] and catalog.has_table(spark, "x_a") and not catalog.has_table(spark, "nothing")
    assert "x_a" in catalog.tables(spark) and catalog.has_function(spark, "lower") and "default" in catalog.databases(spark)
    assert catalog.query(spark, "SELECT * FROM x_a WHERE id = :v", v=0).count() == 1
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("in.txt", "1")
    assert landing.conditional_extract(str(tmp_path / "z.zip"), str(tmp_path / "o")) and not landing.conditional_extract(str(tmp_path / "z.zip"), str(tmp_path / "o"))
    src = tmp_path / "src.txt"
    src.write_text("x")
    assert landing.conditional_download(src.as_uri(), str(tmp_path / "d/x.txt")) and not landing.conditional_download(src.as_uri(), str(tmp_path / "d/x.txt"))
    assert landing.not_yet(["b", "a", "c", "a"], {"b"}, 1) == [["a"], ["c"]]


def test_streamed_editions(spark, tmp_path):
    src, out, chk = (str(tmp_path / x) for x in ("in", "out", "chk"))
    spark.createDataFrame([(1, 2023)], "v int, edition int").write.parquet(src)
    s = lambda: spark.readStream.schema("v int, edition int").parquet(src)
    append_editions(s(), out, ["edition"], chk).awaitTermination()
    spark.createDataFrame([(5, 2023), (2, 2024)], "v int, edition int").write.mode("append").parquet(src)
    append_editions(s(), out, ["edition"], chk).awaitTermination()
    assert sorted(r.v for r in spark.read.parquet(out).collect()) == [1, 2]


def test_feeds(spark, tmp_path):
    from kinlink.sources import feeds

    assert feeds.ipeds_feed("HD", 2022).file == "hd2022.zip" and feeds.ipeds_feed("hd", 2023, "_x").base == "HD2023_X"
    assert feeds.tiger_feed("Unsd", 2023, 1).url.endswith("/TIGER2023/UNSD/tl_2023_01_unsd.zip")
    assert feeds.edge_feed("public", 2023).file == "EDGE_GEOCODE_PUBLICSCH_2324.zip" and feeds.edge_feed("Private", 2009).base.endswith("_0910")
    with pytest.raises(ValueError):
        feeds.edge_feed("other", 2023)
    assert feeds.state_codes(["tl_2023_06_unsd.zip", "tl_2023_01_unsd.zip", "x"]) == ["01", "06"]
    (tmp_path / "hd2011.csv").write_text("unitid,name\n01, a \n")
    assert feeds.hd_editions(spark, [str(tmp_path / "hd2011.csv")]).first().name == "a"
    d = feeds.edge_edition(spark.createDataFrame([("M", 1), ("x", 2)], "cnty string, v int"), 2023)
    assert sorted(map(str, map(tuple, d.collect()))) == ["('x', 2, 2023)", "(None, 1, 2023)"]
    cells = lambda c: spark.createDataFrame([(c,)], "cells map<string,string>")
    s = feeds.scraped_schools(cells({"NCES School ID": "1", "District": "d"}), cells({"PSS_SCHOOL_ID": "A", "PSS_FIPS": "6"})).orderBy("nces").collect()
    assert (s[0].nces, s[0].public_private, s[0].state_fips, s[1].district, s[1].fips) == ("0000A", "private", "6", "d", None)
    g = spark.createDataFrame([("01", "11111", "n", "+1.5", "-2.5", 2024, None)], "statefp string, unsdlea string, name string, intptlat string, intptlon string, edition int, geom binary")
    assert feeds.layer_table(g, "school_district").first().center_latitude == 1.5


def test_files_of_one_header_are_read_at_once(spark, tmp_path):
    for y in range(2001, 2013):
        (tmp_path / f"hd{y}.csv").write_text(("a,b\n1,2\n" if y % 2 else "b,c\n3,4\n"))
    d = readers.csv_files(spark, [str(tmp_path / f"hd{y}.csv") for y in range(2001, 2013)])
    got = sorted((r.edition, r.a, r.b, r.c) for r in d.collect())
    assert got == [(y, "1", "2", None) if y % 2 else (y, None, "3", "4") for y in range(2001, 2013)]
    assert d._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 2


def test_lookups(spark):
    page = "<table><tr><td>Details</td></tr><tr><td>NCAA High School Code</td><td>123</td></tr><tr><td>CEEB Code</td><td>000456</td></tr><tr><td>High School Name</td><td>Oak &amp; Elm <b>High</b></td></tr><tr><td>Address</td><td>1 Oak St<br>Ayton<br>NY  - 12345</td></tr></table>"
    d = spark.createDataFrame([("000456", page), ("000789", "<span class='x error'> No such code </span>"), ("1", None)], "code string, html string")
    got = sorted(map(tuple, readers.lookups(d, "code", "html").collect()), key=lambda r: r[1])
    assert got == [("123", "000456", "Oak & Elm<br>High", "1 Oak St", "Ayton", "NY", "12345", None), (None, "000789", None, None, None, None, None, "No such code"), (None, "1", None, None, None, None, None, None)]


def test_small_helpers(spark, tmp_path):
    assert [readers.state_title(x) for x in ("DISTRICT OF COLUMBIA", "NEW YORK")] == ["District of Columbia", "New York"]
    path = landing.save_responses([{"hits": {"hits": [{"_source": {"org_full_name": "A"}}]}}], str(tmp_path / "j"), "New York")
    assert [tuple(r) for r in readers.json_hits(spark, path, "org_full_name string").collect()] == [("A", "New York")]
    sinks.replace_table(spark.range(100).selectExpr("100 - id AS v"), str(tmp_path / "t"), cluster_by=["v"])
    assert [r.v for r in spark.read.parquet(str(tmp_path / "t")).sort("v").collect()] == list(range(1, 101))
    assert readers.pdf_text(b"<< /Length 9 >>\nstream\nBT <48656C6C6F> Tj ( x) Tj T* <FEFF00E9> Tj ET\nendstream", 0) == "Hello x\n\u00e9"
