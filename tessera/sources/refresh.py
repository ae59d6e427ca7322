"""Reload of a partitioned table that writes only the partitions that changed.

The manifest beside the table holds, per partition, its number of rows and a
hash of its content that does not depend on the order of rows or files: sums
of two 64-bit row hashes. A reload computes the same for the new rows (one
aggregate, combined before its shuffle), compares, and overwrites the changed
partitions only.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.bronze import _hadoop_fs, _swap, stored_columns

ACTIONS = ("kept", "changed", "added", "removed")


def partition_hashes(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """``by, rows, content``: rows and content hash of every partition (a NULL value is a partition).

    Columns are hashed with their names, in name order, so their order does not
    matter while a new, dropped or renamed column changes every partition. NULL
    and empty text differ. Repeated rows count as often as they come.
    """
    named = sorted(c for c in df.columns if c not in by)
    cells: list[Column] = []
    for c in named:
        kind = df.schema[c].dataType.simpleString()
        value = F.to_json(F.struct(F.col(f"`{c}`"))) if kind.startswith(("map", "variant")) else F.col(f"`{c}`")
        cells += [F.lit(f"{c} {kind}"), F.col(f"`{c}`").isNull(), value]
    one, two = F.xxhash64(F.lit(1), *cells), F.xxhash64(F.lit(2), *cells)
    wide = lambda h: F.sum(h.cast("decimal(20,0)"))
    return df.groupBy(*[F.col(f"`{c}`") for c in by]).agg(
        F.count(F.lit(1)).alias("rows"), F.concat_ws(":", wide(one).cast("string"), wide(two).cast("string")).alias("content"))


def compare(new: DataFrame, old: DataFrame | None, by: Sequence[str]) -> DataFrame:
    """``by, rows, old_rows, action``: what a reload does to each partition."""
    n = new.select(*by, F.col("rows"), F.col("content"), F.lit(True).alias("__new"))
    if old is None:
        return n.select(*by, "rows", F.lit(None).cast("long").alias("old_rows"), F.lit("added").alias("action"))
    o = old.select(*[F.col(c).cast(new.schema[c].dataType).alias(f"__o_{c}") for c in by], F.col("rows").alias("old_rows"),
                   F.col("content").alias("__o_content"), F.lit(True).alias("__old"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__o_{c}")) for c in by])
    action = (F.when(F.col("__old").isNull(), F.lit("added")).when(F.col("__new").isNull(), F.lit("removed"))
              .when((F.col("content") == F.col("__o_content")) & (F.col("rows") == F.col("old_rows")), F.lit("kept"))
              .otherwise(F.lit("changed")))
    values = [F.when(F.col("__new").isNull(), F.col(f"__o_{c}")).otherwise(F.col(c)).alias(c) for c in by]
    return n.join(o, same, "full_outer").select(*values, "rows", "old_rows", action.alias("action"))


def manifest_path(path: str) -> str:
    return f"{path.rstrip('/')}.__manifest"


def read_manifest(spark: SparkSession, path: str) -> DataFrame | None:
    where = manifest_path(path)
    return spark.read.parquet(where) if stored_columns(spark, where) is not None else None


def refresh_partitions(df: DataFrame, path: str, by: Sequence[str]) -> DataFrame:
    """Make the table at ``path`` hold ``df``, writing only partitions that differ; returns what was done.

    The result has one row per partition, old or new: ``by, rows, old_rows,
    action`` (kept, changed, added, removed). A table without a manifest, or
    whose columns differ from those of ``df``, is written whole.

    The changed partitions are written by one job with dynamic partition
    overwrite: its files become visible when the job commits, so a job that
    fails leaves the table as it was. The manifest is replaced after that; if
    the run stops in between, the next one finds the old manifest and writes
    the same partitions again. ``df`` is read twice (hash, write) and must give
    the same rows both times: read it from files, or checkpoint it.
    """
    spark = df.sparkSession
    by = list(by)
    stored = stored_columns(spark, path)
    old = read_manifest(spark, path) if stored is not None and set(stored) == set(df.columns) else None
    hashes_at = f"{manifest_path(path)}_{uuid.uuid4().hex}"
    partition_hashes(df, by).write.parquet(hashes_at)
    new = spark.read.parquet(hashes_at)
    done_at = f"{hashes_at}_actions"
    compare(new, old, by).write.parquet(done_at)
    done = spark.read.parquet(done_at)

    fresh = done.filter(F.col("action").isin("changed", "added")).select(*[F.col(c).alias(f"__p_{c}") for c in by])
    same = reduce(lambda a, b: a & b, [F.col(f"`{c}`").eqNullSafe(F.col(f"__p_{c}")) for c in by])
    rows = df.join(fresh, same, "left_semi")
    writer = rows.select(*[c for c in df.columns if c not in by], *by).write.mode("overwrite").partitionBy(*by)
    if old is None:
        staging = f"{path.rstrip('/')}.__staging_{uuid.uuid4().hex}"
        writer.parquet(staging)
        fs, target, jvm = _hadoop_fs(spark, path)
        _swap(fs, jvm.org.apache.hadoop.fs.Path(staging), target, jvm.org.apache.hadoop.fs.Path(f"{staging}_old"))
    else:
        if not fresh.isEmpty():
            writer.option("partitionOverwriteMode", "dynamic").parquet(path)
        _drop_partitions(spark, path, by, done.filter("action = 'removed'"))
    fs, target, jvm = _hadoop_fs(spark, manifest_path(path))
    _swap(fs, jvm.org.apache.hadoop.fs.Path(hashes_at), target, jvm.org.apache.hadoop.fs.Path(f"{hashes_at}_old"))
    return done


def _drop_partitions(spark: SparkSession, path: str, by: Sequence[str], gone: DataFrame) -> None:
    """Delete the folders of partitions that the new rows do not have (their names only come to the driver)."""
    fs, target, jvm = _hadoop_fs(spark, path)
    escape = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    for row in gone.select(*[F.col(c).cast("string") for c in by]).toLocalIterator():
        parts = [escape(c, row[c]) for c in by]
        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{'/'.join(parts)}"), True)
