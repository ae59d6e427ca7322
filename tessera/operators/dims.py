"""Calendar, band and junk dimensions, and the band join."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.columns import financial_year, iso_day_of_week, surrogate_key
from tessera.sources.seeds import local_table


def _date(v) -> Column:
    if isinstance(v, Column):
        return v.cast("date")
    if isinstance(v, str):
        v = _dt.date.fromisoformat(v)
    return F.lit(v)


def _spine(bounds: DataFrame, s: Column, e: Column, name: str) -> DataFrame:
    days = F.sequence(s, F.date_sub(e, 1), F.expr("interval 1 day"))
    return (bounds.select(F.when(s < e, days).otherwise(F.array().cast("array<date>")).alias("d"))
            .select(F.explode("d").alias(name)))


def date_spine(spark: SparkSession, start, end_exclusive, name: str = "date_day") -> DataFrame:
    """One row per day in ``[start, end_exclusive)`` (dates or ISO strings).

    The calendar is bounded by its date range (365 rows a year), not by data
    volume.
    """
    return _spine(spark.range(1), _date(start), _date(end_exclusive), name)


def date_spine_from(bounds: DataFrame, start_col: str = "start", end_col: str = "end_exclusive",
                    name: str = "date_day") -> DataFrame:
    """Day rows for the range held by a one-row ``bounds`` frame (see ``covering_bounds``)."""
    return _spine(bounds, F.col(start_col).cast("date"), F.col(end_col).cast("date"), name)


def calendar_columns(d: Column | str = "date_day", fy_start_month: int = 7) -> list[Column]:
    d = F.col(d) if isinstance(d, str) else d
    return [
        d.alias("date_day"),
        F.year(d).cast("int").alias("year"),
        F.quarter(d).cast("int").alias("quarter"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("quarter_name"),
        F.month(d).cast("int").alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        iso_day_of_week(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        iso_day_of_week(d).isin(6, 7).alias("is_weekend"),
        financial_year(d, fy_start_month).alias("financial_year"),
    ]


def date_dim(spark: SparkSession, start, end_exclusive, fy_start_month: int = 7) -> DataFrame:
    """Day-grain calendar with quarter, month and day names, ISO weekday, weekend flag, financial year."""
    return date_spine(spark, start, end_exclusive).select(*calendar_columns("date_day", fy_start_month))


def date_dim_from(bounds: DataFrame, fy_start_month: int = 7) -> DataFrame:
    """The calendar for a one-row ``(start, end_exclusive)`` frame."""
    return date_spine_from(bounds).select(*calendar_columns("date_day", fy_start_month))


def covering_bounds(*date_cols: tuple[DataFrame, str]) -> DataFrame:
    """One row ``(start, end_exclusive)``: 1 January of the first year and
    1 January after the last year of every given ``(frame, date column)``.

    The date columns are stacked and reduced by one aggregate (partial per
    task, a handful of rows shuffled); nothing is collected.
    """
    parts = [df.select(F.col(c).cast("date").alias("d")) for df, c in date_cols]
    stacked = parts[0]
    for p in parts[1:]:
        stacked = stacked.unionByName(p)
    return stacked.agg(F.trunc(F.min("d"), "year").cast("date").alias("start"),
                       F.add_months(F.trunc(F.max("d"), "year"), 12).cast("date").alias("end_exclusive"))


BAND_SCHEMA = T.StructType([
    T.StructField("band_code", T.StringType(), False),
    T.StructField("band", T.StringType(), False),
    T.StructField("min_value", T.IntegerType(), False),
    T.StructField("max_value", T.IntegerType(), False),
    T.StructField("sort_order", T.IntegerType(), False),
])


def make_bands(spark: SparkSession, start: int, width: int, count: int, open_max: int | None = None,
               prefix: str = "B") -> DataFrame:
    """Equal-width bands from a rule: ``count`` bands of ``width`` from ``start``;
    with ``open_max`` the last band is open (``85+`` style) up to ``open_max``."""
    rows = []
    for i in range(count):
        lo = start + i * width
        last = i == count - 1 and open_max is not None
        hi = open_max if last else lo + width - 1
        label = f"{lo}+" if last else f"{lo}-{hi}"
        rows.append((f"{prefix}{lo:02d}", label, lo, hi, i + 1))
    return local_table(spark, rows, BAND_SCHEMA)


def band_join(df: DataFrame, value: Column | str, bands: DataFrame, code_col: str = "band_code",
              lo: str = "min_value", hi: str = "max_value", out_col: str | None = None,
              how: str = "left", width: int = 64) -> DataFrame:
    """Attach the band whose closed interval ``[lo, hi]`` holds the value.

    One form for any number of bands and any width: each band is cut into
    buckets of ``width`` units and repeated once per bucket it touches, rows
    are joined by equality on the bucket of their value, and the interval is
    checked on the pairs that meet. Choose ``width`` near the usual width of a
    band: wider bands give more rows (``(hi - lo) / width`` each), narrower
    ones more pairs per value. AQE decides whether the bands are broadcast.
    Values and bounds are numbers or dates (a date counts in days). A NULL
    value finds no band; a band with a NULL bound holds nothing.
    """
    v = F.col(value) if isinstance(value, str) else value
    out_col = out_col or code_col
    f = df.withColumn("__band_value", v)

    def bucket(c: Column, kind: T.DataType) -> Column:
        c = F.unix_date(c) if isinstance(kind, T.DateType) else c
        return F.floor(c / F.lit(width)).cast("long")
    f = f.withColumn("__bucket", bucket(F.col("__band_value"), f.schema["__band_value"].dataType))
    b = bands.filter(F.col(lo) <= F.col(hi)).select(
        F.explode(F.sequence(bucket(F.col(lo), bands.schema[lo].dataType), bucket(F.col(hi), bands.schema[hi].dataType)))
        .alias("__band_bucket"), F.col(lo).alias("__lo"), F.col(hi).alias("__hi"), F.col(code_col).alias(out_col))
    inside = (F.col("__band_value") >= F.col("__lo")) & (F.col("__band_value") <= F.col("__hi"))
    j = f.join(b, (F.col("__bucket") == F.col("__band_bucket")) & inside, how)
    return j.drop("__bucket", "__band_bucket", "__lo", "__hi", "__band_value")


def junk_dim(df: DataFrame, cols: Sequence[str], key_col: str = "condition_key") -> DataFrame:
    """Distinct combinations of low-cardinality attributes with a stable hash key.

    ``distinct`` is a hash aggregate with map-side combine, so only the few
    combinations per task cross the shuffle. The key is ``surrogate_key`` of
    the attributes, so a fact computes the same key from its own columns.
    """
    combos = df.select(*cols).distinct()
    return combos.select(surrogate_key(list(cols)).alias(key_col), *cols)
