import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import profile, quality


def _judged(df, columns, load="day"):
    return {(r["load"], r["column_name"]): r for r in profile.judged(profile.profiles(df, load, columns)).collect()}


@pytest.fixture(scope="module")
def loads(spark):
    rng = np.random.default_rng(3)
    rows = []
    for day in range(5):
        n = 4000 if day != 3 else 900
        price = rng.gamma(2.0, 50.0, n) * (3 if day == 4 else 1)
        for i in range(n):
            p = None if day == 2 and i % 10 == 0 else float(price[i])
            rows.append((day, p, f"c{int(rng.integers(0, 500)) + (10_000 if day == 4 else 0)}"))
    return rows, spark.createDataFrame(rows, "day int, price double, code string").repartition(7)


def test_merged_sketches_are_near_the_exact_numbers(loads):
    rows, df = loads
    got = _judged(df, ["price", "code"])
    for day in range(1, 5):
        before = [r for r in rows if r[0] < day]
        prices = np.array([r[1] for r in before if r[1] is not None])
        g = got[day, "price"]
        for quantile, value in zip(profile.TAILS, (g["e_tail_low"], g["e_tail_high"])):
            assert abs((prices <= value).mean() - quantile) < 0.03
        assert abs(g["e_distinct_values"] - len(set(prices))) <= 0.05 * len(set(prices))
        assert abs(got[day, "code"]["e_distinct_values"] - len({r[2] for r in before})) <= 0.05 * 500
        assert (g["e_low"], g["e_high"]) == (prices.min(), prices.max())


def test_sketches_stored_by_load_merge_as_if_read_at_once(spark, loads, tmp_path):
    _, df = loads
    for day in range(5):
        profile.profiles(df.filter(F.col("day") == day), "day", ["price", "code"]).write.mode("append").parquet(str(tmp_path / "p"))
    kept = {(r["load"], r["column_name"]): r for r in profile.judged(spark.read.parquet(str(tmp_path / "p"))).collect()}
    for key, r in _judged(df, ["price", "code"]).items():
        assert kept[key]["faults"] == r["faults"] and kept[key]["rows"] == r["rows"]
        assert abs((kept[key]["e_distinct_values"] or 0) - (r["e_distinct_values"] or 0)) <= 0.05 * (r["e_distinct_values"] or 0)


def test_departures(spark, loads):
    _, df = loads
    got = _judged(df, ["price", "code"])
    assert got[0, "price"]["faults"] == [] == got[0, "price"]["drifts"] and got[0, "price"]["e_distinct_values"] is None
    assert got[1, "price"]["drifts"] == [] == got[1, "code"]["drifts"]
    assert "nulls" in got[2, "price"]["faults"] and got[2, "code"]["faults"] == []
    assert "rows" in got[3, "price"]["faults"] and "rows" in got[3, "code"]["faults"]
    assert "new values" in got[4, "code"]["drifts"] and "high" in got[4, "price"]["faults"]
    stored = profile.profiles(df, "day", ["price", "code"])
    found = profile.departures(stored, [4])
    assert {("code", "new values"), ("price", "high")} <= {(r["column_name"], r["what"]) for r in found.collect()}
    card = quality.scorecard([("prices", df, [quality.Violations("learned_bounds", "*", found)])])
    assert card.first()["violations"] == found.count()
    assert profile.departures(stored, []).count() == 0


def test_odd_columns(spark):
    rows = [(1, None, None, None), (1, None, float("nan"), None), (2, 5, 1.0, "2020-01-01"), (3, 5, 1.0, "2020-01-03")]
    df = spark.createDataFrame(rows, "day int, n long, x double, d string").withColumn("d", F.col("d").cast("date"))
    got = _judged(df, ["n", "x", "d"])
    assert got[1, "n"]["low"] is None and got[1, "n"]["median"] is None and got[1, "n"]["nulls"] == 2
    assert got[1, "x"]["low"] is None and got[1, "x"]["distinct_values"] == 1
    assert got[3, "d"]["low"] - got[2, "d"]["low"] == 2 and "high" in got[3, "d"]["faults"]
    assert profile.judged(profile.profiles(df.limit(0), "day", ["n", "x", "d"])).count() == 0
