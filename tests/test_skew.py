"""A hot key (most rows on one code) must not change results, and the
sort-merge point-in-time join must be split by AQE's skew handling."""

import datetime as dt

from pyspark.sql import functions as F

from tessera.operators import quality, scd2

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "8",
}


def _with_conf(spark, conf):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    return old


def _restore(spark, old):
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_hot_code_point_in_time_join(spark):
    s1 = spark.createDataFrame([(f"C{i}", f"n{i}") for i in range(20)], "code string, name string")
    s2 = spark.createDataFrame([(f"C{i}", f"n{i}" if i else "renamed") for i in range(20)],
                               "code string, name string")
    snap = scd2.snapshot_merge(scd2.snapshot_merge(None, s1, "code", ["name"], dt.datetime(2020, 1, 1)),
                               s2, "code", ["name"], dt.datetime(2021, 1, 1))
    unk = scd2.unknown_member("code", ["name"], "key")
    dim = scd2.versioned_dim(snap, "code", ["name"], key_col="key", unknown=unk)
    # 90% of the fact rows sit on code C0 (which has two versions), some have no code at all
    facts = (spark.range(40000)
             .select("id",
                     F.when(F.col("id") % 10 == 9, F.concat(F.lit("C"), (F.col("id") % 20).cast("string")))
                     .when(F.col("id") % 97 == 0, F.lit(None).cast("string"))
                     .otherwise(F.lit("C0")).alias("code"),
                     F.date_add(F.lit(dt.date(2019, 1, 1)), (F.col("id") % 1000).cast("int")).alias("d")))
    old = _with_conf(spark, SKEW_CONF)
    try:
        out = scd2.point_in_time_join(facts, dim, "code", "d", "code", ["key", "name"], unknown=unk) \
            .select("id", "name")
        rows = out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        _restore(spark, old)
    assert "SortMergeJoin" in plan and "skew=true" in plan
    # brute force on the driver for this small fixture
    versions = [(r.code, r.valid_from, r.valid_to, r.name) for r in dim.collect()]
    want = {}
    for r in facts.collect():
        hit = [n for c, vf, vt, n in versions if c == r.code and vf <= r.d < vt]
        want[r.id] = hit[0] if hit else "Unknown"
    assert len(rows) == 40000
    assert {r.id: r.name for r in rows} == want


def test_hot_key_reconcile_and_duplicates(spark):
    parents = spark.createDataFrame([(k, 3) for k in range(50)], "k int, stated int")
    kids = spark.range(30000).select(F.when(F.col("id") < 29000, F.lit(0))
                                     .otherwise((F.col("id") % 50).cast("int")).alias("k"))
    old = _with_conf(spark, SKEW_CONF)
    try:
        bad = {r.k: r.observed for r in quality.reconcile(parents, kids, "k", "stated").collect()}
        dups = quality.duplicate_keys(kids, ["k"], skip_nulls=True).count()
    finally:
        _restore(spark, old)
    counts = {}
    for r in kids.collect():
        counts[r.k] = counts.get(r.k, 0) + 1
    assert bad == {k: counts.get(k, 0) for k in range(50) if counts.get(k, 0) != 3}
    assert dups == sum(1 for v in counts.values() if v > 1)


def test_salted_point_in_time_join_equals_plain(spark):
    s1 = spark.createDataFrame([(f"C{i}", f"n{i}") for i in range(5)], "code string, name string")
    s2 = spark.createDataFrame([("C0", "renamed")], "code string, name string")
    snap = scd2.snapshot_merge(scd2.snapshot_merge(None, s1, "code", ["name"], dt.datetime(2020, 1, 1)),
                               s2, "code", ["name"], dt.datetime(2021, 1, 1))
    unk = scd2.unknown_member("code", ["name"], "key")
    dim = scd2.versioned_dim(snap, "code", ["name"], key_col="key", unknown=unk)
    facts = spark.range(5000).select(
        "id", F.when(F.col("id") % 7 == 0, F.concat(F.lit("C"), (F.col("id") % 6).cast("string")))
        .otherwise(F.lit("C0")).alias("code"),
        F.date_add(F.lit(dt.date(2020, 6, 1)), (F.col("id") % 400).cast("int")).alias("d"))
    plain = scd2.point_in_time_join(facts, dim, "code", "d", "code", ["key"], unknown=unk)
    salted = scd2.point_in_time_join(facts, dim, "code", "d", "code", ["key"], unknown=unk, salt_buckets=8)
    assert salted.columns == plain.columns
    assert sorted(map(tuple, salted.collect())) == sorted(map(tuple, plain.collect()))
    inner = scd2.point_in_time_join(facts, dim, "code", "d", "code", ["key"], salt_buckets=8)
    assert inner.count() == plain.filter(F.col("code").isin([f"C{i}" for i in range(5)])).count()


def test_hot_customer_of_the_order_fact_is_split(spark, tmp_path):
    """q15 itself: most orders on one customer, broadcasts off."""
    from tessera.plans import star_queries as sq
    sf = "/root/testdata/sf0.001"
    for name in ("customer", "nation", "region", "lineitem"):
        spark.read.parquet(f"{sf}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    o = spark.read.parquet(f"{sf}/orders.parquet")
    one = o.agg(F.min("o_custkey")).first()[0]
    big = o.crossJoin(spark.range(20)).withColumn("o_orderkey", F.col("o_orderkey") * 100 + F.col("id")).drop("id")
    big.withColumn("o_custkey", F.when(F.col("o_orderkey") % 10 < 9, F.lit(one)).otherwise(F.col("o_custkey"))) \
        .repartition(8).write.parquet(f"{tmp_path}/orders.parquet")
    old = _with_conf(spark, SKEW_CONF)
    try:
        out = sq.q15_fact_orders(spark, str(tmp_path))
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        _restore(spark, old)
    assert "skew=true" in plan


def test_orphans_meet_the_parent_as_one_row_per_key(spark):
    child = spark.range(1000).selectExpr("if(id % 10 < 9, 1L, id) k")
    parent = spark.range(5).withColumnRenamed("id", "p")
    got = {r.k: r.n for r in quality.orphans(child, "k", parent, "p").collect()}
    assert len(got) == 100 and all(k % 10 == 9 and n == 1 for k, n in got.items())
