"""Bounds learned from earlier loads.

A load's profile is one row per column: rows, NULLs, least and greatest value,
a sketch of its distinct values (HyperLogLog) and one of its quantiles (KLL).
Profiles are stored with the loads and merge, so that a new load is compared
with all earlier ones without reading them again.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType

BITS = 14                  # HyperLogLog: 2^14 registers, standard error 0.8 %
K = 200                    # KLL: rank error below 1.65 % with 99 % confidence
MARGIN = 0.1               # of the earlier range, by which a value may leave it
NULL_MARGIN = 0.01         # by which the share of NULLs may exceed the largest earlier one
ROWS_FACTOR = 2.0          # by which a load may be smaller or larger than all earlier ones
NEW_SHARE = 0.5            # share of a load's distinct values that may be new
TAILS = (0.05, 0.95)       # quantiles of the earlier loads between which a load's median lies


def _number(df: DataFrame, column: str) -> Column | None:
    """The column as a double (dates: days), or None for a kind that has no order worth bounds."""
    kind, c = df.schema[column].dataType, F.col(f"`{column}`")
    if isinstance(kind, DateType):
        return F.unix_date(c).cast("double")
    return F.nullif(c.cast("double"), F.lit(float("nan"))) if isinstance(kind, NumericType) else None


def profiles(df: DataFrame, load: str, columns: Sequence[str]) -> DataFrame:
    """``load, column_name, rows, nulls, low, high, distincts, quantiles`` of every load in ``df``.

    One aggregate, combined before its shuffle. A column that is neither a
    number nor a date has no low, high and quantiles; NaN counts as a value
    without a place in them. An all-NULL column has no low and high.
    """
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for i, c in enumerate(columns):
        value, number = F.col(f"`{c}`"), _number(df, c)
        aggs += [F.count_if(value.isNull()).alias(f"__nulls{i}"), F.hll_sketch_agg(value.cast("string"), BITS).alias(f"__hll{i}")]
        if number is not None:
            aggs += [F.min(number).alias(f"__low{i}"), F.max(number).alias(f"__high{i}"), F.kll_sketch_agg_double(number, K).alias(f"__kll{i}")]
    wide = df.groupBy(F.col(f"`{load}`").alias("load")).agg(*aggs)
    none = lambda kind: F.lit(None).cast(kind)
    cells = []
    for i, c in enumerate(columns):
        has = _number(df, c) is not None
        cells.append(F.struct(
            F.lit(c).alias("column_name"), F.col("__rows").alias("rows"), F.col(f"__nulls{i}").alias("nulls"),
            (F.col(f"__low{i}") if has else none("double")).alias("low"), (F.col(f"__high{i}") if has else none("double")).alias("high"),
            F.col(f"__hll{i}").alias("distincts"), (F.col(f"__kll{i}") if has else none("binary")).alias("quantiles")))
    return wide.select("load", F.explode(F.array(*cells)).alias("c")).select("load", "c.*")


def earlier(given: DataFrame) -> DataFrame:
    """Every profile beside the merged one of all loads before it (``e_*``; NULL for a column's first load).

    ``given`` has one row per load and column, whatever the loads' sizes.
    """
    w = Window.partitionBy("column_name").orderBy("load").rowsBetween(Window.unboundedPreceding, -1)
    return given.select(
        "*", F.count("load").over(w).alias("e_loads"), F.min("rows").over(w).alias("e_least_rows"), F.max("rows").over(w).alias("e_most_rows"),
        F.max(F.try_divide("nulls", "rows")).over(w).alias("e_null_share"), F.min("low").over(w).alias("e_low"),
        F.max("high").over(w).alias("e_high"), F.hll_union_agg("distincts").over(w).alias("e_distincts"),
        F.kll_merge_agg_double("quantiles").over(w).alias("e_quantiles"))


def judged(given: DataFrame) -> DataFrame:
    """Every profile with what its earlier loads let expect and how it departs from them.

    ``faults`` follow from exact numbers: ``low``, ``high`` (beyond the earlier
    range by more than ``MARGIN`` of it), ``nulls``, ``rows``. ``drifts`` follow
    from the sketches, within their error: ``median`` (outside the earlier
    ``TAILS``), ``new values`` (of a column of codes or names: more than
    ``NEW_SHARE`` of its distinct values were never seen). A column's first load
    has neither.
    """
    e = earlier(given)
    slack = (F.col("e_high") - F.col("e_low")) * MARGIN
    distinct, before = F.hll_sketch_estimate("distincts"), F.hll_sketch_estimate("e_distincts")
    fresh = F.greatest(F.hll_sketch_estimate(F.hll_union("distincts", "e_distincts")) - before, F.lit(0))
    known = F.col("e_loads") > 0
    # no sketch of no values is asked for a quantile
    at = lambda sketch, low, q: F.when(F.col(low).isNotNull(), F.kll_sketch_get_quantile_double(sketch, F.lit(q)))
    e = e.select("*", distinct.alias("distinct_values"), F.when(known, before).alias("e_distinct_values"),
                 F.when(known, fresh).alias("new_values"), at("quantiles", "low", 0.5).alias("median"),
                 at("e_quantiles", "e_low", TAILS[0]).alias("e_tail_low"), at("e_quantiles", "e_low", TAILS[1]).alias("e_tail_high"))
    faults = {"low": F.col("low") < F.col("e_low") - slack, "high": F.col("high") > F.col("e_high") + slack,
              "nulls": F.try_divide("nulls", "rows") > F.col("e_null_share") + NULL_MARGIN,
              "rows": (F.col("rows") * ROWS_FACTOR < F.col("e_least_rows")) | (F.col("rows") > F.col("e_most_rows") * ROWS_FACTOR)}
    drifts = {"median": (F.col("median") < F.col("e_tail_low")) | (F.col("median") > F.col("e_tail_high")),
              "new values": F.col("quantiles").isNull() & (F.col("new_values") > F.col("distinct_values") * NEW_SHARE)}
    listed = lambda found: F.array_compact(F.array(*[F.when(known & cond, F.lit(name)) for name, cond in found.items()]))
    return e.select("*", listed(faults).alias("faults"), listed(drifts).alias("drifts")).drop(
        "distincts", "quantiles", "e_distincts", "e_quantiles")


def departures(given: DataFrame, loads: Sequence[object] | None = None) -> DataFrame:
    """``load, column_name, what``: one row per fault or drift (of ``loads`` only, if given), as ``quality.Violations`` counts."""
    rows = judged(given).select("load", "column_name", F.explode(F.concat("faults", "drifts")).alias("what"))
    return rows if loads is None else rows.filter(reduce(lambda a, b: a | b, [F.col("load").eqNullSafe(F.lit(v)) for v in loads], F.lit(False)))
