"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import checkpointed


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every node of ``edges``; root is the smallest node of its component.

    Alternating large-star and small-star steps: each round hangs every node
    under the smallest neighbour it knows, which needs a logarithmic number of
    rounds even for long chains.  A hub is only ever the target of grouped
    minima (combined before the shuffle) and the build key of a join that AQE
    can split, so no neighbour list is gathered.  Every round is checkpointed.
    Rows with a null end and self links are ignored; an empty table gives no rows.
    """
    e = (edges.select(F.col(a).alias("u"), F.col(b).alias("v"))
         .where("u is not null and v is not null and u <> v").distinct())
    e = checkpointed(e)
    if e.isEmpty():
        return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    signature = None
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(low, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u")
        e = (small.select(F.col("v").alias("u"), F.col("m").alias("v"))
             .union(small.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        e = checkpointed(e)
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == signature:
            break
        signature = tuple(now)
    roots = e.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
