from kinlink.plans import he


def write(spark, folder, name, data, schema):
    spark.createDataFrame(data, schema).write.parquet(f"{folder}/{name}.parquet")


def colleges(spark, folder):
    named = [(1, "Alpha College", 1, "01234500"), (2, "Zephyrine Quillmore University", 2, None), (3, "Gamma Institute", 2, "00777700")] + [(i, f"{chr(65 + i)}{chr(97 + i)}lo Academy", 2, None) for i in range(10, 25)]
    hd = [(u, u, o, f, n, "1 Oak St", "Springdale", "Oak County", "NY", "12345", 36, 36001, "42.0", "-75.0", 1, 2024) for u, n, f, o in named]
    write(spark, folder, "ipeds_hd", hd, "rec_id bigint, unitid int, opeid string, f1systyp int, instnm string, addr string, city string, countynm string, stabbr string, zip string, fips int, countycd int, latitude string, longitud string, sector int, edition int")
    write(spark, folder, "ceeb_school", [("NY", "New York")], "state_abbr string, state string")
    u = [(1, "New York", "Alpha College", "0001"), (2, "New York", "Zephyrine Quillmoore University", "0002"), (3, "New York", "Xu Seminary", "0003"), (4, "New York", "Wo Seminary", "0004")]
    write(spark, folder, "ceeb_university", u, "rec_id bigint, state string, name string, ceeb_code string")


def test_full_coverage_counts_fuzzy_matches(spark, tmp_path):
    colleges(spark, tmp_path)
    assert [tuple(r) for r in he.he_fuzzy(spark, str(tmp_path)).select("ceeb", "ipeds").collect()] == [("0002", "2")]
    cross = he.he_crosswalk(spark, str(tmp_path)).collect()
    ids = {x: [r for r in cross if r[x] is not None and r[f"{x}_name"] is not None] for x in ("ipeds", "ceeb", "nsc")}
    assert {x: len(r) for x, r in ids.items()} == {"ipeds": 18, "ceeb": 4, "nsc": 2}
    want = {f"{x}_by_{y}": f"{round(round(sum(r[y] is not None for r in ids[x]) / len(ids[x]), 4) * 100, 6)}%" for x in ids for y in ids if x != y}
    got = {r.name: r.value for r in he.he_coverage(spark, str(tmp_path)).collect()}
    assert got == want and (got["ceeb_by_ipeds"], got["ipeds_by_ceeb"], got["nsc_by_ceeb"]) == ("50.0%", "11.11%", "50.0%")
    exact = {r.name: r.value for r in he.he_exact_coverage(spark, str(tmp_path)).collect()}
    assert (exact["ceeb_by_ipeds"], exact["ipeds_by_ceeb"]) == ("25.0%", "5.56%")


def test_repeated_names_score_once(spark, tmp_path):
    colleges(spark, tmp_path)
    once = he.he_fuzzy(spark, str(tmp_path)).collect()
    u = spark.read.parquet(f"{tmp_path}/ceeb_university.parquet")
    (tmp_path / "b").mkdir()
    u.unionByName(u).write.parquet(f"{tmp_path}/b/ceeb_university.parquet")
    for t in ("ipeds_hd", "ceeb_school"):
        spark.read.parquet(f"{tmp_path}/{t}.parquet").write.parquet(f"{tmp_path}/b/{t}.parquet")
    assert he.he_fuzzy(spark, f"{tmp_path}/b").collect() == once
