import json

import pytest
from pyspark.sql import functions as F

from tessera.sources import bronze


def test_csv_bom_short_long_quoted_empty(spark, tmp_path):
    p = tmp_path / "x_Crash.csv"
    p.write_bytes("﻿A,B,C\n1,2,3\n4,5\n6,7,8,9\n\"\",x,\n".encode("utf-8"))
    df = bronze.read_text_csv(spark, str(p))
    assert df.columns == ["A", "B", "C"]
    assert [tuple(r) for r in df.collect()] == [("1", "2", "3"), ("4", "5", None), ("6", "7", "8"), (None, "x", None)]
    assert all(str(f.dataType) == "StringType()" for f in df.schema.fields)


def test_read_extract_routes_and_reports_missing(spark, tmp_path):
    (tmp_path / "2024_Crash.csv").write_text("REPORT_ID,x\n1,a\n")
    (tmp_path / "2024_Units.csv").write_text("REPORT_ID,y\n1,b\n")
    (tmp_path / "readme.txt").write_text("ignored")
    with pytest.raises(bronze.MissingEntityError, match="casualties"):
        bronze.read_extract(spark, str(tmp_path), {"crashes": "_Crash.csv", "casualties": "_Casualty.csv",
                                                  "units": "_Units.csv"})
    (tmp_path / "2024_Casualty.csv").write_text("REPORT_ID,z\n1,c\n")
    frames = bronze.read_extract(spark, str(tmp_path), {"crashes": "_Crash.csv", "casualties": "_Casualty.csv",
                                                       "units": "_Units.csv"})
    row = frames["crashes"].first()
    assert row.x == "a" and row[bronze.SOURCE_RESOURCE] == "2024_Crash.csv"


def test_latest_extract(spark, tmp_path):
    doc = {"success": True, "result": {"resources": [
        {"name": "Road Crash Data 2012-2016", "url": "http://h/a.zip"},
        {"name": "Road Crash Data 2019-2023", "url": "http://h/b.zip"},
        {"name": "Road Crash Data 2020-2024", "url": "http://h/c.csv"},
        {"name": "Old Road Crash Data 2020-2024", "url": "http://h/d.zip"},
        {"name": "Road Crash Data 2015-2023", "url": "http://h/e.zip"}]}}
    p = tmp_path / "cat.json"
    p.write_text(json.dumps(doc))
    cat = spark.read.option("multiLine", True).json(str(p))
    best = bronze.require_one(bronze.latest_extract(cat, r"Road Crash Data \d{4}-(\d{4})"), "extract")
    assert best == {"name": "Road Crash Data 2019-2023", "url": "http://h/b.zip", "end_year": 2023}
    with pytest.raises(bronze.NoExtractError):
        bronze.require_one(bronze.latest_extract(cat, r"Nothing (\d{4})"), "extract")


def test_flatten_codes(spark, tmp_path):
    doc = {"data": {"codelists": [{"codes": [{"id": "40070", "name": "Adelaide"}, {"id": "4", "name": "SA"}]}]}}
    p = tmp_path / "codes.json"
    p.write_text(json.dumps(doc))
    df = bronze.flatten_codes(spark.read.option("multiLine", True).json(str(p)))
    assert [tuple(r) for r in df.collect()] == [("40070", "Adelaide"), ("4", "SA")]


def test_union_by_name(spark):
    a = spark.createDataFrame([("1", "x")], "a string, b string")
    b = spark.createDataFrame([("y", "2"), ("z", "3")], "b string, a string")
    c = spark.createDataFrame([("4",)], "a string")
    u = bronze.union_parts([a, b, c])
    assert sorted(map(tuple, u.collect()), key=str) == sorted([("1", "x"), ("2", "y"), ("3", "z"), ("4", None)], key=str)


def test_land_text_and_refresh(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.5)], "k int, v double")
    landed = bronze.land_text(df, "src.csv")
    assert landed.columns == ["k", "v", bronze.SOURCE_RESOURCE, bronze.INGESTED_AT]
    assert landed.first().k == "1"
    path = str(tmp_path / "t")
    r1 = bronze.full_refresh(landed, path)
    assert r1["rows"] == 1 and not r1["exists"]
    r2 = bronze.full_refresh(landed.select("v", "k", bronze.SOURCE_RESOURCE, bronze.INGESTED_AT), path)
    assert r2["exists"] and r2["same"]
    r3 = bronze.full_refresh(landed.withColumn("extra", F.lit("e")), path)
    assert r3["added"] == ["extra"] and not r3["same"]
    assert spark.read.parquet(path).columns[-1] == "extra"


def test_latest_extract_tie_goes_to_first_listed(spark, tmp_path):
    doc = {"result": {"resources": [
        {"name": "Road Crash Data 2019-2024", "url": "http://h/first.zip"},
        {"name": "Road Crash Data 2020-2024", "url": "http://h/second.zip"},
        {"name": "Road Crash Data 2018-2023", "url": "http://h/older.ZIP"}]}}
    p = tmp_path / "cat.json"
    p.write_text(json.dumps(doc))
    cat = spark.read.option("multiLine", True).json(str(p))
    best = bronze.require_one(bronze.latest_extract(cat, r"Road Crash Data \d{4}-(\d{4})"), "extract")
    assert best["url"] == "http://h/first.zip" and best["end_year"] == 2024


def test_full_refresh_keeps_old_table_when_write_fails(spark, tmp_path):
    import os
    path = str(tmp_path / "t")
    bronze.full_refresh(spark.createDataFrame([("1",)], "k string"), path)
    bad = spark.createDataFrame([("x",)], "k string").select(F.col("k").cast("int").alias("k"))  # ANSI: fails
    with pytest.raises(Exception):
        bronze.full_refresh(bad, path)
    assert [r.k for r in spark.read.parquet(path).collect()] == ["1"]
    assert not any(n.startswith("t.__staging") for n in os.listdir(tmp_path))


def test_csv_quotes_newlines_and_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text('k,v\n1,"say ""hi"", now"\n2,"two\nlines"\n3,\n')
    (tmp_path / "b.csv").write_text("v,k\nx,4\n")
    got = {r.k: r.v for r in bronze.read_text_csv(spark, f"{tmp_path}/*.csv").collect()}
    assert got == {"1": 'say "hi", now', "2": "two\nlines", "3": None, "4": "x"}
    kept = {r.k: r.v for r in bronze.read_text_csv(spark, f"{tmp_path}/*.csv", blank_as_null=False).collect()}
    assert kept["3"] == ""


def test_failed_swap_keeps_the_old_table(spark, tmp_path, monkeypatch):
    import pytest
    path = str(tmp_path / "t")
    bronze.full_refresh(spark.range(3), path)

    def broken(fs, staged, target, old):
        raise OSError("store is gone")
    monkeypatch.setattr(bronze, "_swap", broken)
    with pytest.raises(OSError):
        bronze.full_refresh(spark.range(5), path)
    assert spark.read.parquet(path).count() == 3


def test_require_one_rejects_two(spark):
    import pytest
    with pytest.raises(bronze.NoExtractError):
        bronze.require_one(spark.range(2), "row")


def test_latest_entry_by_group(spark):
    rows = [(1, "en/3 a", "u1.zip", "en"), (2, "en/7 b", "u2.ZIP", "en"), (0, "en/7 c", "u3.zip", "en"), (5, "en/9 d", "u4.txt", "en"),
            (6, "de/1 e", "u5.zip", "de"), (7, None, "u6.zip", "fr"), (8, "x de/9", "u7.zip", "de")]
    entries = spark.createDataFrame(rows, "pos int, name string, url string, lang string")
    best = bronze.latest_entry(entries, r"([a-z]{2})/(\d+)", 2, ".zip", by=["lang"])
    assert {(r.lang, r.pos, r.end_year) for r in best.collect()} == {("en", 0, 7), ("de", 6, 1)}
    assert bronze.latest_entry(entries.limit(0), r"(\d+)").count() == 0


def test_code_lists_in_text_whatever_the_documents_hold(spark):
    lists = '{"data": {"codelists": [{"codes": %s}]}, "more": {"deep": [1, 2]}}'
    docs = [(1, lists % '[{"id": "A", "name": "Alpha"}, {"name": "Beta", "id": 7, "x": {}}, {"id": true}]'), (2, lists % "[]"),
            (3, lists % '{"id": "A"}'), (4, '{"data": {}}'), (5, "{broken"), (6, None), (7, lists % '[{"name": "none"}, 3, null, {"id": null}]'),
            (8, "[]"), (9, "")]
    got = bronze.flatten_code_text(spark.createDataFrame(docs, "k int, doc string"), "doc", keep=["k"])
    assert sorted(map(tuple, got.collect()), key=str) == sorted([
        (1, 0, "A", "Alpha", None), (1, 1, "7", "Beta", None), (1, 2, "true", None, None), (3, None, None, None, "no list"),
        (4, None, None, None, "no list"), (5, None, None, None, "not json"), (6, None, None, None, "not json"),
        (7, 0, None, "none", "no code"), (7, 1, None, None, "no code"), (7, 2, None, None, "no code"), (7, 3, None, None, "no code"),
        (8, None, None, None, "no list"), (9, None, None, None, "not json")], key=str)


def test_large_file_without_quoted_breaks_is_split(spark, tmp_path):
    lines = ["id,name,note"] + [f'{i},"n ""{i}"", x",{"" if i % 3 else "t"}' for i in range(20000)]
    (tmp_path / "big.csv").write_text("﻿" + "\n".join(lines) + "\n", encoding="utf-8")
    (tmp_path / "other.csv").write_text("name,id\nb,-1\n")
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for k in old:
            spark.conf.set(k, "65536")
        whole = bronze.read_text_csv(spark, f"{tmp_path}/*.csv")
        split = bronze.read_text_csv(spark, f"{tmp_path}/*.csv", quoted_breaks=False)
        assert split.rdd.getNumPartitions() > whole.rdd.getNumPartitions()
        assert split.count() == 20001
        assert sorted(map(str, split.select(*whole.columns).collect())) == sorted(map(str, whole.collect()))
        assert split.filter("id = '7'").first().asDict() == {"id": "7", "name": 'n "7", x', "note": None}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
