"""Data-quality checks and the scorecard.

Every check counts violations. Row-level checks of one table (not NULL,
accepted values, between, max between, row count) are fused into a single
aggregation pass; each uniqueness check is one shuffle with map-side combine;
a relationship check is one anti join. The scorecard is a small DataFrame
``(table_name, check_name, column_name, violations)``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCORE_COLUMNS = ["table_name", "check_name", "column_name", "violations"]


@dataclass(frozen=True)
class NotNull:
    column: str


@dataclass(frozen=True)
class AcceptedValues:
    column: str
    values: Sequence[object]


@dataclass(frozen=True)
class Between:
    column: str
    low: object = None
    high: object = None
    row_condition: str | None = None


@dataclass(frozen=True)
class MaxBetween:
    column: str
    low: object = None
    high: object = None


@dataclass(frozen=True)
class RowCountBetween:
    low: int | None = None
    high: int | None = None


@dataclass(frozen=True)
class Unique:
    column: str


@dataclass(frozen=True)
class UniqueCombination:
    columns: Sequence[str]


@dataclass(frozen=True)
class Violations:
    """A singular check: ``rows`` holds one row per violation (e.g. the output
    of ``reconcile`` or ``coverage_gaps``); the scorecard counts them."""
    name: str
    column: str
    rows: DataFrame = field(compare=False)


class DataQualityError(RuntimeError):
    """Raised by ``assert_clean`` when a check has violations."""


@dataclass(frozen=True)
class Relationship:
    column: str
    parent: DataFrame = field(compare=False)
    parent_column: str
    parent_name: str = ""


def _in_range(c: Column, low, high) -> Column:
    cond = F.lit(True)
    if low is not None:
        cond = cond & (c >= F.lit(low))
    if high is not None:
        cond = cond & (c <= F.lit(high))
    return cond


def _row_level(table: str, df: DataFrame, checks: Sequence) -> DataFrame | None:
    """One aggregation pass for all row-level checks of a table."""
    aggs: list[Column] = []
    labels: list[tuple[str, str]] = []
    for i, ch in enumerate(checks):
        name = f"__c{i}"
        if isinstance(ch, NotNull):
            aggs.append(F.count_if(F.col(ch.column).isNull()).alias(name))
            labels.append(("not_null", ch.column))
        elif isinstance(ch, AcceptedValues):
            c = F.col(ch.column)
            aggs.append(F.count_if(c.isNotNull() & ~c.isin(*ch.values)).alias(name))
            labels.append(("accepted_values", ch.column))
        elif isinstance(ch, Between):
            c = F.col(ch.column)
            bad = c.isNotNull() & ~_in_range(c, ch.low, ch.high)
            if ch.row_condition:
                bad = bad & F.coalesce(F.expr(ch.row_condition), F.lit(False))
            aggs.append(F.count_if(bad).alias(name))
            labels.append(("between", ch.column))
        elif isinstance(ch, MaxBetween):
            m = F.max(F.col(ch.column))
            aggs.append(F.when(m.isNotNull() & ~_in_range(m, ch.low, ch.high), 1).otherwise(0)
                        .cast("long").alias(name))
            labels.append(("max_between", ch.column))
        elif isinstance(ch, RowCountBetween):
            n = F.count(F.lit(1))
            aggs.append(F.when(~_in_range(n, ch.low, ch.high), 1).otherwise(0).cast("long").alias(name))
            labels.append(("row_count_between", "*"))
    if not aggs:
        return None
    return _stacked(table, df.agg(*aggs), labels)


def duplicate_keys(df: DataFrame, cols: Sequence[str], skip_nulls: bool) -> DataFrame:
    """Key values held by more than one row (NULL keys skipped for ``unique``)."""
    base = df.select(*cols)
    if skip_nulls:
        base = base.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols]))
    return base.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def _uniqueness(table: str, df: DataFrame, checks: Sequence) -> DataFrame | None:
    """All uniqueness checks of a table in one pass: the rows are expanded once
    to the checks' key sets and counted by one exchange.

    A set's keys that occur more than once are violations; ``Unique`` leaves
    NULL out, in a combination NULLs are equal.
    """
    sets = [(("unique", c.column, [c.column], True) if isinstance(c, Unique)
             else ("unique_combination", ",".join(c.columns), list(c.columns), False)) for c in checks]
    if not sets:
        return None
    cols = sorted({c for *_, keys, _ in sets for c in keys})
    mask = lambda keys: sum(1 << (len(cols) - 1 - i) for i, c in enumerate(cols) if c not in keys)
    distinct = list(dict.fromkeys(tuple(sorted(keys)) for *_, keys, _ in sets))
    counted = df.select(*cols).groupingSets([[F.col(c) for c in keys] for keys in distinct], *[F.col(c) for c in cols]).agg(
        F.count(F.lit(1)).alias("__n"), F.grouping_id().alias("__set"))
    aggs = []
    for i, (_, _, keys, skip_nulls) in enumerate(sets):
        bad = F.col("__set") == mask(keys)
        if skip_nulls:
            bad = bad & F.col(keys[0]).isNotNull()
        aggs.append(F.count_if(bad).alias(f"__c{i}"))
    return _stacked(table, counted.filter(F.col("__n") > 1).agg(*aggs), [(name, label) for name, label, *_ in sets])


def _stacked(table: str, wide: DataFrame, labels: Sequence[tuple[str, str]]) -> DataFrame:
    """The counts ``__c0, __c1, ...`` of one row as scorecard rows."""
    stack = ", ".join(f"'{chk}', '{col}', cast(`__c{i}` as bigint)" for i, (chk, col) in enumerate(labels))
    return wide.selectExpr(f"stack({len(labels)}, {stack}) as (check_name, column_name, violations)") \
        .select(F.lit(table).alias("table_name"), "check_name", "column_name", "violations")


def orphans(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Non-NULL child keys that the parent lacks, with the number of child rows (``n``).

    Child rows are counted per key first (combined before the shuffle), so a
    hot key reaches the join as one row per task.
    """
    child = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    keys = parent.select(F.col(parent_column).alias("__pk"))
    return child.join(keys, F.col(column) == F.col("__pk"), "left_anti")


def scorecard(tables: Sequence[tuple[str, DataFrame, Sequence]]) -> DataFrame:
    """Run the checks of every ``(table_name, frame, checks)`` into one scorecard.

    A table's row-level checks are one aggregate and its uniqueness checks one
    expanded aggregate; each relationship joins keys counted beforehand.
    """
    parts: list[DataFrame] = []
    for table, df, checks in tables:
        fused = _row_level(table, df, [c for c in checks if isinstance(
            c, (NotNull, AcceptedValues, Between, MaxBetween, RowCountBetween))])
        if fused is not None:
            parts.append(fused)
        unique = _uniqueness(table, df, [c for c in checks if isinstance(c, (Unique, UniqueCombination))])
        if unique is not None:
            parts.append(unique)
        for ch in checks:
            if isinstance(ch, Violations):
                n = ch.rows.agg(F.count(F.lit(1)).alias("violations"))
                parts.append(n.select(F.lit(table).alias("table_name"), F.lit(ch.name).alias("check_name"),
                                      F.lit(ch.column).alias("column_name"), "violations"))
            elif isinstance(ch, Relationship):
                n = orphans(df, ch.column, ch.parent, ch.parent_column).agg(
                    F.coalesce(F.sum("n"), F.lit(0)).alias("violations"))
                parts.append(n.select(F.lit(table).alias("table_name"), F.lit("relationships").alias("check_name"),
                                      F.lit(ch.column).alias("column_name"), "violations"))
    if not parts:
        raise ValueError("no checks given")
    return reduce(lambda a, b: a.unionByName(b), parts)


def assert_clean(card: DataFrame) -> None:
    """Fail like a test run: raise when any check of the scorecard has
    violations. Only the failing rows (at most one per check) reach the driver."""
    bad = card.filter(F.col("violations") > 0).collect()
    if bad:
        lines = [f"{r.table_name}.{r.column_name} {r.check_name}: {r.violations}" for r in bad]
        raise DataQualityError("data-quality checks failed:\n" + "\n".join(lines))


def reconcile(parent: DataFrame, child: DataFrame, key: str, stated: str, measure: Column | None = None,
              child_key: str | None = None) -> DataFrame:
    """Parents whose stated measure differs from the aggregate of their children.

    ``measure`` defaults to the child row count. Children are aggregated per
    key first (map-side combine), then left-joined to the parents, so a parent
    without children compares against 0 instead of vanishing; a NULL stated
    value is not a violation. Output: key, stated, observed.
    """
    ck = child_key or key
    m = measure if measure is not None else F.count(F.lit(1))
    per_key = child.groupBy(F.col(ck).alias("__ck")).agg(m.alias("__observed"))
    j = parent.select(key, stated).join(per_key, F.col(key) == F.col("__ck"), "left")
    observed = F.coalesce(F.col("__observed"), F.lit(0).cast(per_key.schema["__observed"].dataType))
    return (j.select(F.col(key), F.col(stated), observed.alias("observed"))
            .filter(F.col(stated) != F.col("observed")))


def coverage_gaps(required: DataFrame, available: DataFrame, column: str) -> DataFrame:
    """Distinct values of ``required`` missing from ``available`` (anti join).

    A NULL required value never matches, so it is reported as a gap, as a
    left join filtered on the missing side would report it."""
    need = required.select(column).distinct()
    have = available.select(column).distinct()
    return need.join(have, column, "left_anti")
