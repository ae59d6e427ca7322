import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import intervals

DAY = dt.date(2000, 1, 1)
END = dt.date(9999, 12, 31)
L = "k string, a int, valid_from date, valid_to date"
R = "k string, b int, valid_from date, valid_to date"


def some(rng, n, keys):
    out = []
    for i in range(n):
        s = DAY + dt.timedelta(days=rng.randint(-3000, 3000))
        e = rng.choice([None, END, s, s + dt.timedelta(days=rng.randint(-5, 40)), s + dt.timedelta(days=rng.randint(1, 4000))])
        out.append((rng.choice(keys), i, None if rng.random() < 0.03 else rng.choice([s, s, s, dt.date(1, 1, 1)]), e))
    return out


def brute(left, right, keyed=True):
    found = []
    for k, a, s, e in left:
        for m, b, t, f in right:
            if None in (s, t) or (keyed and (k is None or k != m)):
                continue
            x, y = max(s, t), min(e or END, f or END)
            if x < y and s < (e or END) and t < (f or END):
                found.append((k, a, b, x, y) if keyed else (a, b, x, y))
    return sorted(found, key=str)


@pytest.mark.parametrize("salt, few", [(1, 0), (3, 0), (1, 1000), (2, 33)])
@pytest.mark.parametrize("keys", [["x"], ["x", "y", None, "z"]])
def test_against_all_pairs(spark, keys, salt, few):
    rng = random.Random(len(keys))
    left, right = some(rng, 120, keys), some(rng, 90, keys)
    got = intervals.overlap_join(spark.createDataFrame(left, L), spark.createDataFrame(right, R), ["k"], salt_buckets=salt, few=few)
    assert got.columns == ["k", "a", "b", "overlap_from", "overlap_to"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(left, right)


def test_without_keys_and_clashes(spark):
    rng = random.Random(4)
    left, right = some(rng, 40, ["x"]), some(rng, 40, ["x"])
    l, r = spark.createDataFrame(left, L), spark.createDataFrame(right, R)
    got = intervals.overlap_join(l.drop("k"), r.drop("k"), [])
    assert sorted(map(tuple, got.collect()), key=str) == brute(left, right, keyed=False)
    assert intervals.overlap_join(l.limit(0), r, ["k"]).count() == 0
    with pytest.raises(ValueError, match="both sides"):
        intervals.overlap_join(l, r.withColumnRenamed("b", "a"), ["k"])


def test_blocks_tile_every_interval(spark):
    rng = random.Random(8)
    spans = [(s, s + n) for s, n in [(0, 1), (0, 3652059), (15, 2), (16, 16), (17, 300), (730000, 0)]]
    spans += [(s, s + rng.randint(1, 10 ** rng.randint(1, 6))) for s in (rng.randint(0, 10 ** 6) for _ in range(60))]
    df = spark.createDataFrame(spans, "s long, e long").select("s", "e", intervals.blocks(F.col("s"), F.col("e")).alias("b"))
    for s, e, found in df.collect():
        parts = sorted((x.block * 16 ** x.size, (x.block + 1) * 16 ** x.size) for x in found)
        assert len(parts) <= 2 * intervals.BASE * intervals.SIZES
        if s == e:
            assert not parts
        else:
            assert parts[0][0] == s and parts[-1][1] == e and all(a[1] == b[0] for a, b in zip(parts, parts[1:]))


def test_long_intervals_of_one_key_do_not_make_all_pairs(spark):
    """2,000 short and 50 endless intervals of one key: the join's candidates are its result, and no nested loop is planned."""
    short = [("k", i, DAY + dt.timedelta(days=i), DAY + dt.timedelta(days=i + 2)) for i in range(2000)]
    left = spark.createDataFrame(short + [("k", -i, dt.date(1, 1, 1), None) for i in range(1, 51)], L)
    right = spark.createDataFrame([(k, i, s, e) for k, i, s, e in short], R)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        got = intervals.overlap_join(left, right, ["k"])
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan and "SortMergeJoin" in plan
        assert "__block" in plan
        assert got.count() == 2000 * 50 + 2000 + 2 * 1999
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old[0])
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", old[1])
