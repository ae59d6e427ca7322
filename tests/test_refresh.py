import os

import pytest
from pyspark.sql import functions as F

from tessera.sources import refresh

DDL = "k long, name string, year int, place string"


def rows_of(df):
    return sorted(map(str, df.select("k", "name", "year", "place").collect()))


def files_of(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def actions_of(done, by):
    return {tuple(r[c] for c in by): (r["action"], r["rows"], r["old_rows"]) for r in done.collect()}


@pytest.fixture()
def table(spark, tmp_path):
    rows = [(i, f"n{i % 7}" if i % 5 else None, 2000 + i % 4, "x/y=z" if i % 2 else None) for i in range(80)]
    return spark.createDataFrame(rows, DDL), str(tmp_path / "t")


def test_only_changed_partitions_are_written(spark, table):
    df, path = table
    by = ["year", "place"]
    assert {a[0] for a in actions_of(refresh.refresh_partitions(df, path, by), by).values()} == {"added"}
    assert rows_of(spark.read.parquet(path)) == rows_of(df)
    before = files_of(path)

    done = refresh.refresh_partitions(df.repartition(5).select("place", "name", "k", "year"), path, by)
    assert {a[0] for a in actions_of(done, by).values()} == {"kept"} and files_of(path) == before

    changed = df.withColumn("name", F.when((F.col("year") == 2001) & (F.col("k") % 3 == 0), F.lit("")).otherwise(F.col("name")))
    changed = changed.filter("year <> 2003 or place is null").unionByName(spark.createDataFrame([(500, "new", 2009, None)], DDL))
    got = actions_of(refresh.refresh_partitions(changed, path, by), by)
    assert {k for k, a in got.items() if a[0] == "changed"} == {(2001, "x/y=z")}
    assert {k for k, a in got.items() if a[0] == "removed"} == {(2003, "x/y=z")}
    assert {k for k, a in got.items() if a[0] == "added"} == {(2009, None)}
    assert rows_of(spark.read.parquet(path)) == rows_of(changed)
    after = files_of(path)
    assert {f for f, t in before.items() if after.get(f) != t} == {f for f in before if "year=2001/" in f or "year=2003/" in f}


def test_repeated_rows_and_new_columns_change_the_content(spark, table):
    df, path = table
    refresh.refresh_partitions(df, path, ["year"])
    one = df.filter("k = 4")
    got = actions_of(refresh.refresh_partitions(df.unionByName(one), path, ["year"]), ["year"])
    assert got[(2000,)] == ("changed", 21, 20) and got[(2001,)][0] == "kept"
    wider = df.withColumn("more", F.lit(1))
    assert {a[0] for a in actions_of(refresh.refresh_partitions(wider, path, ["year"]), ["year"]).values()} == {"added"}
    assert set(spark.read.parquet(path).columns) == {"k", "name", "year", "place", "more"}


def test_a_failed_job_leaves_the_table(spark, table):
    df, path = table
    refresh.refresh_partitions(df, path, ["year"])
    before = files_of(path)
    failing = df.withColumn("name", F.when(F.col("k") == 41, F.raise_error(F.lit("broken")).cast("string")).otherwise(F.lit("other")))
    with pytest.raises(Exception, match="broken"):
        refresh.refresh_partitions(failing, path, ["year"])
    assert files_of(path) == before and rows_of(spark.read.parquet(path)) == rows_of(df)
    # fails while it writes: the hash is taken of good rows, the write meets a bad file
    old = refresh.read_manifest(spark, path)
    changed = df.withColumn("name", F.lit("later"))
    broken = changed.withColumn("name", F.when(F.rand() >= 0, F.raise_error(F.lit("lost")).cast("string")).otherwise(F.lit("")))
    with pytest.raises(Exception, match="lost"):
        broken.write.mode("overwrite").partitionBy("year").option("partitionOverwriteMode", "dynamic").parquet(path)
    assert rows_of(spark.read.parquet(path)) == rows_of(df) and old.count() == 4
    assert {a[0] for a in actions_of(refresh.refresh_partitions(changed, path, ["year"]), ["year"]).values()} == {"changed"}
    assert rows_of(spark.read.parquet(path)) == rows_of(changed)


def test_empty_tables(spark, table):
    df, path = table
    assert refresh.refresh_partitions(df.limit(0), path, ["year"]).count() == 0
    assert spark.read.schema(df.schema).parquet(path).count() == 0
    assert refresh.refresh_partitions(df, path, ["year"]).count() == 4
    done = refresh.refresh_partitions(df.limit(0), path, ["year"])
    assert {r["action"] for r in done.collect()} == {"removed"} and spark.read.schema(df.schema).parquet(path).count() == 0
