"""A parent and its child table stored so that joins between them need no exchange.

Both are bucketed and sorted by the key and a place. Most keys have the one
place 0. A key with more than ``hot_rows`` child rows (a NULL key too) gets as
many places as keep each under that number: its child rows are dealt to the
places by a hash of the row, its parent row is stored at every place. So a
bucket never has to hold a whole hot key, and a join on key and place still
finds each pair once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PLACE = "__place"
HOT_ROWS = 1_000_000
HOWS = ("inner", "left", "left_semi", "left_anti")


@dataclass(frozen=True)
class Pair:
    """Catalog names of the two stored tables and the column of each that they are joined by."""
    parent: str
    child: str
    parent_key: str
    child_key: str


def hot_keys(child: DataFrame, child_key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``__key, __places`` of the keys with more than ``hot_rows`` rows; counted before any shuffle of rows."""
    n = child.groupBy(F.col(f"`{child_key}`").alias("__key")).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > hot_rows)
    return n.select("__key", F.ceil(F.col("__n") / hot_rows).cast("int").alias("__places"))


def store_pair(parent: DataFrame, child: DataFrame, parent_key: str, child_key: str, name: str, path: str, buckets: int,
               hot_rows: int = HOT_ROWS) -> Pair:
    """Store both tables under ``path`` as catalog tables ``<name>_parent`` and ``<name>_child``.

    ``buckets`` is the number of buckets of both (about one for every 256 MB of
    the child). The keys must have the same type. Parent keys are expected to be
    unique; one that repeats joins every child once for each of its rows, as in
    any join. Rows that are equal in all columns share a place.
    """
    kinds = parent.schema[parent_key].dataType, child.schema[child_key].dataType
    if kinds[0] != kinds[1]:
        raise ValueError(f"keys of different types are never in the same bucket: {kinds[0].simpleString()}, {kinds[1].simpleString()}")
    if PLACE in parent.columns + child.columns:
        raise ValueError(f"column {PLACE} is taken")
    spark, base = child.sparkSession, path.rstrip("/")
    hot_keys(child, child_key, hot_rows).write.parquet(f"{base}/hot")
    hot = spark.read.parquet(f"{base}/hot")

    def placed(df, key, place):
        with_places = df.join(hot, F.col(f"`{key}`").eqNullSafe(F.col("__key")), "left")
        return with_places.withColumn(PLACE, place).select(*[F.col(f"`{c}`") for c in df.columns], PLACE)

    places = F.coalesce(F.col("__places"), F.lit(1))
    row = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in child.columns]), places).cast("int")
    tables = ((f"{name}_parent", placed(parent, parent_key, F.explode(F.sequence(F.lit(0), places - 1))), parent_key),
              (f"{name}_child", placed(child, child_key, row), child_key))
    for table, df, key in tables:
        # the same hash as the buckets': one task writes one file for each bucket
        (df.repartition(buckets, F.col(f"`{key}`"), F.col(PLACE)).write.format("parquet").bucketBy(buckets, key, PLACE)
         .sortBy(key, PLACE).option("path", f"{base}/{table}").saveAsTable(table))
    return Pair(f"{name}_parent", f"{name}_child", parent_key, child_key)


def joined(spark: SparkSession, pair: Pair, how: str = "inner") -> DataFrame:
    """Child rows with their parent's columns: the join of the two stored tables, bucket by bucket.

    The child is the left side; joins that would return unmatched parents are
    refused, for a parent is stored once at each place. A NULL key has no parent.
    """
    if how not in HOWS:
        raise ValueError(f"how must be one of {', '.join(HOWS)}")
    c, p = spark.table(pair.child), spark.table(pair.parent).withColumnRenamed(PLACE, "__parent_place")
    p = p.withColumnRenamed(pair.parent_key, "__parent_key")
    both = c.join(p, (F.col(f"`{pair.child_key}`") == F.col("__parent_key")) & (F.col(PLACE) == F.col("__parent_place")), how)
    out = both.drop(PLACE, "__parent_place")
    return out.drop("__parent_key") if pair.parent_key == pair.child_key else out.withColumnRenamed("__parent_key", pair.parent_key)


def orphan_rows(spark: SparkSession, pair: Pair) -> DataFrame:
    """Child rows whose non-NULL key the parent lacks (the relationship check), without an exchange of rows."""
    return joined(spark, pair, "left_anti").filter(F.col(f"`{pair.child_key}`").isNotNull())


def parents(spark: SparkSession, pair: Pair) -> DataFrame:
    """The parent table as it was given: each row once."""
    return spark.table(pair.parent).filter(F.col(PLACE) == 0).drop(PLACE)


def children(spark: SparkSession, pair: Pair) -> DataFrame:
    """The child table as it was given."""
    return spark.table(pair.child).drop(PLACE)
