"""Strict typing that sets malformed rows aside instead of stopping the job.

A strict cast fails the whole load at the first bad cell. Here every cell is
parsed by a rule that yields NULL for what it does not accept; a row with no
fault goes to the typed table, any other to the rejects, with one entry per
faulty cell: column, raw text, rule. Both come from one pass over the source.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.sources.bronze import full_refresh

ERRORS = "_errors"
REJECTED = "_rejected"
REQUIRED = "required"


@dataclass(frozen=True)
class Rule:
    """How the typed ``column`` is read from the text column ``source``.

    ``parse`` returns NULL for text that it does not accept. A NULL cell is no
    fault unless ``required``; an empty one is text and has to be accepted.
    """

    column: str
    source: str
    name: str
    parse: Callable[[Column], Column]
    required: bool = False


def number(column: str, source: str, kind: str = "int", required: bool = False) -> Rule:
    """Text that casts to ``kind`` without loss of range (``int``, ``bigint``, ``decimal(p,s)``, ``double``)."""
    return Rule(column, source, kind, lambda c: c.try_cast(kind), required)


def moment(column: str, source: str, fmt: str = "yyyy-MM-dd HH:mm:ss", kind: str = "timestamp", required: bool = False) -> Rule:
    """A timestamp (or, with ``kind="date"``, its date) written in one format."""
    return Rule(column, source, f"{kind} {fmt}", lambda c: F.try_to_timestamp(c, F.lit(fmt)).cast(kind), required)


def one_of(column: str, source: str, values: Sequence[str], required: bool = False) -> Rule:
    """One of the accepted values."""
    return Rule(column, source, "accepted values", lambda c: F.when(c.isin(*values), c), required)


def matching(column: str, source: str, pattern: str, required: bool = False) -> Rule:
    """Text that the pattern matches somewhere (anchor it with ``^`` and ``\\z``)."""
    return Rule(column, source, f"matches {pattern}", lambda c: F.when(c.rlike(pattern), c), required)


def code_before(column: str, source: str, sep: str, required: bool = False) -> Rule:
    """The integer code of ``code<sep>label`` text."""
    return Rule(column, source, f"code before {sep}", lambda c: F.trim(F.split_part(c, F.lit(sep), F.lit(1))).try_cast("int"), required)


def route(df: DataFrame, rules: Sequence[Rule], keep: Sequence[str] = ()) -> DataFrame:
    """The columns to ``keep`` as they are, the typed columns, and ``_errors``: the faults of the row.

    One projection without a shuffle. Two rules may read the same source
    column; the fault names the typed one. A faulty cell is NULL in its typed
    column.
    """
    repeated = {r.column for r in rules if [x.column for x in rules].count(r.column) > 1} | (set(keep) & {r.column for r in rules})
    if repeated:
        raise ValueError(f"column named twice: {sorted(repeated)}")
    faults = []
    for r in rules:
        raw = F.col(f"`{r.source}`")
        broken = F.when(raw.isNull(), F.lit(REQUIRED) if r.required else F.lit(None).cast("string")).when(
            r.parse(raw).isNull(), F.lit(r.name))
        faults.append(F.when(broken.isNotNull(), F.struct(F.lit(r.column).alias("column"), raw.cast("string").alias("raw"),
                                                          broken.alias("rule"))))
    return df.select(*[F.col(f"`{c}`") for c in keep], *[r.parse(F.col(f"`{r.source}`")).alias(r.column) for r in rules],
                     F.array_compact(F.array(*faults)).alias(ERRORS))


def typed(routed: DataFrame) -> DataFrame:
    """The rows without a fault."""
    return routed.filter(F.size(ERRORS) == 0).drop(ERRORS)


def rejects(routed: DataFrame, keep: Sequence[str]) -> DataFrame:
    """One row per faulty cell: the kept columns, ``column, raw, rule``."""
    return routed.select(*[F.col(f"`{c}`") for c in keep], F.explode(ERRORS).alias("__e")).select(
        *[F.col(f"`{c}`") for c in keep], "__e.*")


def summary(routed: DataFrame) -> DataFrame:
    """``column, rule, cells``: faulty cells by column and rule, and the rows ``read``, ``typed`` and ``rejected`` under ``*``.

    One scan; the counts are combined before the only, tiny, shuffle. The
    three totals are there for an empty table too.
    """
    spark = routed.sparkSession
    clean = F.size(ERRORS) == 0
    own = F.array(F.struct(F.lit("*").alias("column"), F.lit("read").alias("rule")),
                  F.struct(F.lit("*").alias("column"), F.when(clean, F.lit("typed")).otherwise(F.lit("rejected")).alias("rule")))
    marks = routed.select(F.explode(F.concat(own, F.transform(ERRORS, lambda e: F.struct(
        e["column"].alias("column"), e["rule"].alias("rule"))))).alias("m")).select("m.*", F.lit(1).alias("n"))
    zeros = spark.createDataFrame([("*", r, 0) for r in ("read", "typed", "rejected")], "column string, rule string, n int")
    return marks.unionByName(zeros).groupBy("column", "rule").agg(F.sum("n").alias("cells"))


def land_typed(df: DataFrame, rules: Sequence[Rule], path: str, keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame, dict]:
    """Write typed and rejected rows in one job; returns both tables and the row counts.

    The job writes one table with two partitions, which is swapped in when it
    has succeeded (``full_refresh``), so typed and rejected rows are always of
    the same load and a failed job leaves the last one.
    """
    spark = df.sparkSession
    routed = route(df, rules, keep)
    done = full_refresh(routed.withColumn(REJECTED, F.size(ERRORS) > 0), path, partition_by=[REJECTED])
    schema = routed.schema.add(REJECTED, "boolean")
    stored = spark.read.schema(schema).parquet(path)
    bad = stored.filter(F.col(REJECTED)).drop(REJECTED)
    n_bad = bad.count()
    counts = {"read": done["rows"], "typed": done["rows"] - n_bad, "rejected": n_bad}
    return stored.filter(~F.col(REJECTED)).drop(REJECTED, ERRORS), rejects(bad, keep), counts
