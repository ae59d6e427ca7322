"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.session import checkpointed, stored

__all__ = ["checkpointed", "free_name", "join_small", "running_total", "stored", "table"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables; read by Spark only, so any store works."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` has it (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def join_small(large: DataFrame, small: DataFrame, on: Sequence[str], how: str, rows: int = 500_000) -> DataFrame:
    """Join with a stored table of narrow rows: broadcast if it has at most ``rows`` of them, else both sides shuffle."""
    return large.join(F.broadcast(small) if small.count() <= rows else small, list(on), how)


def running_total(df: DataFrame, order: Sequence[str], value: Column, out: str,
                  by: Sequence[str] = ()) -> DataFrame:
    """Add ``out``: the sum of ``value`` over all earlier rows in ``order`` (within ``by``).

    With ``value = lit(1)`` that is a gapless row number from 0.  No group goes
    through one task: rows are range partitioned on ``by + order`` (so a hot
    group spreads over many partitions), each partition is summed on its own,
    and the partition sums (one row per partition and group) give the offsets.
    The dealt rows are checkpointed first, because a range partitioning that is
    computed again need not cut at the same rows.
    """
    value_col, pid = "_running_value", "_running_part"
    dealt = df.withColumn(value_col, value.cast("long"))
    dealt = dealt.repartitionByRange(*by, *order).withColumn(pid, F.spark_partition_id())
    dealt = checkpointed(dealt)
    parts = dealt.groupBy(*by, pid).agg(F.sum(value_col).alias("_part_sum"))
    offset = Window.partitionBy(*by).orderBy(pid).rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(*by, pid, F.coalesce(F.sum("_part_sum").over(offset), F.lit(0)).alias("_offset"))
    local = Window.partitionBy(*by, pid).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = dealt.withColumn("_local", F.coalesce(F.sum(value_col).over(local), F.lit(0)))
    return (rows.join(offsets, [*by, pid])
            .withColumn(out, F.col("_offset") + F.col("_local"))
            .drop(value_col, pid, "_offset", "_local"))
