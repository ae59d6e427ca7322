"""Per-capita rate report across two independent facts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def per_capita(numerator: Column, denominator: Column, per: int = 10_000, digits: int = 1,
               numerator_scale: int = 0) -> Column:
    """``round(numerator * per / denominator, digits)`` rounded half away from
    zero, as a double.

    Computed in exact integer arithmetic: the numerator is an integer count of
    ``10**-numerator_scale`` units (``numerator_scale=2`` for money in cents),
    ``q = (2*|n|*f + d) div (2*d)`` is the correctly rounded result in units of
    ``10**-digits``, then ``q / 10**digits`` as a double. Any engine that
    divides integers gives the same digits, unlike rounding a binary double.
    The denominator must be positive (the report filters ``population > 0``).
    """
    f = per * 10 ** digits
    if numerator_scale:
        # n counts 10**-scale units; fold the scale into the factor.
        if 10 ** numerator_scale > f or f % 10 ** numerator_scale:
            raise ValueError("numerator_scale too large for exact rounding")
        f = f // 10 ** numerator_scale
    n = numerator.cast("decimal(38,0)")
    d = denominator.cast("decimal(38,0)")
    a = F.abs(n) * F.lit(2 * f).cast("decimal(38,0)") + d
    b = d * F.lit(2).cast("decimal(38,0)")
    # exact floor division of non-negative integers: (a - a mod b) / b
    q = ((a - a % b) / b).cast("long") * F.signum(n).cast("long")
    return q.cast("double") / F.lit(float(10 ** digits))


def rate_report(numerator_fact: DataFrame, denominator_fact: DataFrame, dim: DataFrame,
                keys: Sequence[str], numerator_aggs: Mapping[str, Column], denominator_col: str,
                dim_key: str, dim_cols: Sequence[str], rates: Mapping[str, tuple[str, int]],
                per: int = 10_000, digits: int = 1, denominator_name: str = "population") -> DataFrame:
    """Aggregate each fact to ``keys`` on its own, join the two aggregates
    (inner: a rate exists only where both sides do), decorate with the
    dimension, keep positive denominators and compute rates.

    ``rates`` maps an output name to ``(numerator column, numerator_scale)``.
    Both facts are reduced by partial (map-side) aggregation before any join,
    so the joins see one row per key on each side; the dimension join is a
    broadcast whenever its measured size allows (AQE).
    """
    num = numerator_fact.groupBy(*keys).agg(*[c.alias(n) for n, c in numerator_aggs.items()])
    den = (denominator_fact.groupBy(*keys)
           .agg(F.sum(F.col(denominator_col)).cast("long").alias(denominator_name)))
    return _rates(num, den, dim, keys, list(numerator_aggs), dim_key, dim_cols, rates, per, digits, denominator_name)


def _rates(num: DataFrame, den: DataFrame, dim: DataFrame, keys: Sequence[str], measures: Sequence[str], dim_key: str,
           dim_cols: Sequence[str], rates: Mapping[str, tuple[str, int]], per: int, digits: int, denominator_name: str) -> DataFrame:
    d = dim.select(F.col(dim_key).alias(keys[0]), *[c for c in dim_cols if c != keys[0]])
    j = num.join(den, list(keys), "inner").join(d, keys[0], "inner").filter(F.col(denominator_name) > 0)
    out = [*dim_cols, *[k for k in keys if k != keys[0]], *measures, denominator_name]
    rate_cols = [per_capita(F.col(src), F.col(denominator_name), per, digits, scale).alias(name)
                 for name, (src, scale) in rates.items()]
    return j.select(*[F.col(c) for c in out], *rate_cols)


ROWS, SIGN, TOUCHED = "rows", "sign", "touched"


def change_set(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """What turns one load into the next: the rows that go (``sign`` -1) and those that come (+1).

    ``key`` names a row in both loads (unique in each); a row that differs in
    any column goes and comes. Columns are compared NULL-safe.
    """
    cols = list(after.columns)
    old = before.select(F.col(key).alias("__o"), F.struct(*cols).alias("__old"))
    new = after.select(F.col(key).alias("__n"), F.struct(*cols).alias("__new"))
    j = old.join(new, F.col("__o").eqNullSafe(F.col("__n")), "full_outer").filter(~F.col("__old").eqNullSafe(F.col("__new")))
    both = F.array(F.struct(F.lit(-1).alias(SIGN), F.col("__old").alias("r")), F.struct(F.lit(1).alias(SIGN), F.col("__new").alias("r")))
    return j.select(F.explode(both).alias("c")).filter(F.col("c.r").isNotNull()).select(*[F.col(f"c.r.`{c}`").alias(c) for c in cols], f"c.{SIGN}")


def rate_state(fact: DataFrame, keys: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    """Stored sums of a fact: ``keys, rows`` and each measure's sum.

    ``measures`` are additive per row and exact (integers or decimals), so that
    rows can be taken out of a sum again; ``lit(1)`` counts rows.
    """
    return fact.groupBy(*keys).agg(F.count(F.lit(1)).alias(ROWS), *[F.sum(c).alias(n) for n, c in measures.items()])


def apply_changes(state: DataFrame, changes: DataFrame, keys: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    """The state after ``changes`` (fact rows with ``sign``), with ``touched``: whether the group had any.

    The changes are summed by group with their signs, which is all that is
    shuffled of them, and added to the stored sums; a group whose last row goes
    stays, marked and with 0 rows, until ``settled``. Rows that go must have
    been counted before; a group that falls below 0 rows fails the run.
    """
    delta = changes.groupBy(*[F.col(k).alias(f"__k_{k}") for k in keys]).agg(
        F.sum(SIGN).alias("__rows"), *[F.sum(c * F.col(SIGN)).alias(f"__m_{n}") for n, c in measures.items()], F.lit(True).alias("__new"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__k_{k}"))
    j = state.withColumn("__have", F.lit(True)).join(delta, same, "full_outer")
    have = F.col("__have").isNotNull()
    plus = lambda a, b, kind: (F.coalesce(F.col(a), F.lit(0)) + F.coalesce(F.col(b), F.lit(0))).cast(kind)
    rows = plus(ROWS, "__rows", "long")
    checked = F.when(rows < 0, F.raise_error(F.lit("a row is taken out that was never counted")).cast("long")).otherwise(rows)
    return j.select(*[F.when(have, F.col(k)).otherwise(F.col(f"__k_{k}")).alias(k) for k in keys], checked.alias(ROWS),
                    *[plus(n, f"__m_{n}", state.schema[n].dataType).alias(n) for n in measures], F.col("__new").isNotNull().alias(TOUCHED))


def settled(state: DataFrame) -> DataFrame:
    """The state to store: without empty groups and marks."""
    return state.filter(F.col(ROWS) > 0).drop(TOUCHED)


def refresh_report(report: DataFrame, numerator: DataFrame, denominator: DataFrame, dim: DataFrame, keys: Sequence[str],
                   measures: Sequence[str], dim_key: str, dim_cols: Sequence[str], rates: Mapping[str, tuple[str, int]],
                   per: int = 10_000, digits: int = 1, denominator_name: str = "population") -> DataFrame:
    """A ``rate_report`` brought up to date: rows of touched groups are made anew, all others are taken as they are.

    ``numerator`` and ``denominator`` are states from ``apply_changes``, the
    latter with its measure named ``denominator_name``; ``report`` has the
    dimension columns and the later keys, and the dimension's ``dim_key`` must
    be told by its ``dim_cols``. A group is touched if either side is, which
    is settled on the (small) states; the untouched part of the report is only
    filtered. Adds ``recomputed``.
    """
    touched = numerator.filter(TOUCHED).select(*keys).unionByName(denominator.filter(TOUCHED).select(*keys)).distinct()
    same = lambda df: df.select(*[F.col(k).alias(f"__t_{k}") for k in keys])
    match = F.lit(True)
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"__t_{k}"))
    some = lambda state, cols: settled(state).join(same(touched), match, "left_semi").select(*keys, *cols)
    fresh = _rates(some(numerator, measures), some(denominator, [denominator_name]), dim, keys, measures, dim_key, dim_cols, rates,
                   per, digits, denominator_name)
    named = touched.join(dim.select(F.col(dim_key).alias(keys[0]), *[c for c in dim_cols if c != keys[0]]), keys[0])
    by = [*dim_cols, *[k for k in keys if k != keys[0]]]
    gone = named.select(*[F.col(c).alias(f"__g_{c}") for c in by])
    hit = F.lit(True)
    for c in by:
        hit = hit & F.col(c).eqNullSafe(F.col(f"__g_{c}"))
    kept = report.join(gone, hit, "left_anti")
    return kept.withColumn("recomputed", F.lit(False)).unionByName(fresh.withColumn("recomputed", F.lit(True)))
