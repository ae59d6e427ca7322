import datetime as dt

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tessera.operators import dims
from tessera.sources import seeds


def test_date_dim_bounds(spark):
    d = dims.date_dim(spark, "2015-01-01", "2027-01-01")
    assert d.count() == 4383
    row = d.filter(F.col("date_day") == dt.date(2020, 7, 1)).first()
    assert (row.year, row.quarter, row.quarter_name, row.month, row.month_name, row.day_of_week, row.day_name,
            row.is_weekend, row.financial_year) == (2020, 3, "Q3", 7, "July", 3, "Wednesday", False, 2021)
    assert d.filter("is_weekend").first().day_of_week in (6, 7)


def test_age_bands(spark):
    ages = spark.createDataFrame([(a,) for a in [0, 4, 5, 84, 85, 120, None]], "age int")
    got = dims.band_join(ages, "age", seeds.age_bands(spark), code_col="age_band_code", lo="min_age", hi="max_age")
    pairs = sorted(((r.age if r.age is not None else -1), r.age_band_code) for r in got.collect())
    assert pairs == [(-1, None), (0, "A04"), (4, "A04"), (5, "A59"), (84, "A80"), (85, "8599"), (120, "8599")]


def test_fractional_band_join(spark):
    bands = dims.make_bands(spark, 1, 10, 5, prefix="Q")
    v = spark.createDataFrame([(1.0,), (10.0,), (10.5,), (50.0,), (0.5,), (None,)], "q double")
    got = sorted(((r.q if r.q is not None else -1), r.band_code) for r in dims.band_join(v, "q", bands).collect())
    assert got == [(-1, None), (0.5, None), (1.0, "Q01"), (10.0, "Q01"), (10.5, None), (50.0, "Q41")]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(min_value=-5, max_value=1100)), min_size=1, max_size=40))
def test_exploded_equals_range_join(spark, values):
    bands = seeds.age_bands(spark)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, age int")
    got = dims.band_join(df, "age", bands, code_col="age_band_code", lo="min_age", hi="max_age").collect()
    rows = bands.collect()
    want = [(i, v, next((b.age_band_code for b in rows if v is not None and b.min_age <= v <= b.max_age), None))
            for i, v in enumerate(values)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_many_and_wide_bands(spark):
    many = spark.range(10_001).selectExpr("concat('b', id) band_code", "cast(id * 3 as int) min_value", "cast(id * 3 + 2 as int) max_value")
    df = spark.createDataFrame([(0,), (30_002,), (30_003,), (7,)], "v int")
    got = {r.v: r.band_code for r in dims.band_join(df, "v", many).collect()}
    assert got == {0: "b0", 30_002: "b10000", 30_003: None, 7: "b2"}
    wide = spark.createDataFrame([("w", 0, 200_000)], "band_code string, min_value int, max_value int")
    joined = dims.band_join(df, "v", wide)
    assert {r.band_code for r in joined.collect()} == {"w"}
    assert "NestedLoop" not in joined._jdf.queryExecution().executedPlan().toString()


def test_junk_dim(spark):
    df = spark.createDataFrame([("a", None, True), ("a", None, True), ("a", "x", False)], "t string, w string, f boolean")
    j = dims.junk_dim(df, ["t", "w", "f"], "k")
    assert j.count() == 2 and j.select("k").distinct().count() == 2


def test_covering_bounds(spark):
    a = spark.createDataFrame([(dt.date(1999, 3, 4),), (dt.date(2001, 2, 1),)], "d date")
    b = spark.createDataFrame([(dt.date(1998, 12, 31),)], "e date")
    row = dims.covering_bounds((a, "d"), (b, "e")).first()
    assert (row.start, row.end_exclusive) == (dt.date(1998, 1, 1), dt.date(2002, 1, 1))
    cal = dims.date_dim_from(dims.covering_bounds((a, "d")))
    assert cal.count() == 365 + 366 + 365          # 1999, 2000 (leap), 2001
