import uuid

import pytest
from pyspark.sql import functions as F

from tessera.sources import colocated

HOT = 40


def _pair(spark, tmp_path, parent, child, hot_rows=HOT, buckets=4):
    return colocated.store_pair(parent, child, "k", "pk", f"t_{uuid.uuid4().hex}", str(tmp_path / "s"), buckets, hot_rows)


@pytest.fixture()
def tables(spark):
    parent = spark.createDataFrame([(k, f"p{k}") for k in range(0, 30, 2)] + [(None, "nobody")], "k long, name string")
    rows = [(i, 4 if i % 3 == 0 else None if i % 3 == 1 and i % 2 else i % 31, i % 7) for i in range(600)]
    return parent, spark.createDataFrame(rows, "id long, pk long, v int")


def _sorted(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("how", colocated.HOWS)
def test_joins_equal_those_of_the_given_tables(spark, tmp_path, tables, how):
    parent, child = tables
    pair = _pair(spark, tmp_path, parent, child)
    got = colocated.joined(spark, pair, how)
    want = child.join(parent, child["pk"] == parent["k"], how).select(*got.columns)
    assert _sorted(got) == _sorted(want) and got.count() > 0


def test_rows_are_stored_whole_and_hot_keys_in_many_places(spark, tmp_path, tables):
    parent, child = tables
    pair = _pair(spark, tmp_path, parent, child)
    assert _sorted(colocated.children(spark, pair)) == _sorted(child) and _sorted(colocated.parents(spark, pair)) == _sorted(parent)
    places = {r["pk"]: (r["n"], r["most"]) for r in spark.table(pair.child).groupBy("pk", colocated.PLACE).count()
              .groupBy("pk").agg(F.count("*").alias("n"), F.max("count").alias("most")).collect()}
    assert places[4][0] > 3 and places[None][0] > 1
    assert places[4][1] < 2 * HOT and places[5][0] == 1
    assert spark.table(pair.parent).filter("k = 4").count() == places[4][0]
    lost = colocated.orphan_rows(spark, pair)
    assert _sorted(lost) == _sorted(child.join(parent, child["pk"] == parent["k"], "left_anti").filter("pk is not null"))


def _exchanges(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange")


def test_joins_and_relationship_check_have_no_exchange(spark, tmp_path, tables):
    parent, child = tables
    pair = _pair(spark, tmp_path, parent, child)
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    try:
        for k in old:
            spark.conf.set(k, "-1")
        for how in colocated.HOWS:
            joined = colocated.joined(spark, pair, how)
            assert _exchanges(joined) == 0
            assert "Bucketed: true" in joined._jdf.queryExecution().executedPlan().toString()
        assert _exchanges(colocated.orphan_rows(spark, pair)) == 0
        assert _exchanges(child.join(parent, child["pk"] == parent["k"])) >= 2
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_empty_tables_and_refused_input(spark, tmp_path, tables):
    parent, child = tables
    none = _pair(spark, tmp_path / "a", parent.limit(0), child.limit(0))
    assert colocated.joined(spark, none, "left").count() == 0
    alone = _pair(spark, tmp_path / "b", parent.limit(0), child)
    assert colocated.joined(spark, alone, "left").count() == child.count() and colocated.joined(spark, alone).count() == 0
    with pytest.raises(ValueError, match="types"):
        _pair(spark, tmp_path / "c", parent, child.withColumn("pk", F.col("pk").cast("int")))
    with pytest.raises(ValueError, match="how"):
        colocated.joined(spark, alone, "full")
    with pytest.raises(ValueError, match="taken"):
        _pair(spark, tmp_path / "d", parent, child.withColumn(colocated.PLACE, F.lit(1)))
