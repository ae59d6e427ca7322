"""Joins of histories by overlap of their intervals.

Two intervals overlap exactly when the later start lies in the other one, so a
pair is found once, at that start. Each interval is cut into aligned blocks of
days of the sizes 1, ``BASE``, ``BASE``^2, ...: the largest ones that fit inside
it and smaller ones at both ends, a few dozen rows however long it is. A day
lies in one block of each size. So "start in interval" becomes equality on
(key, size, block): a hash join without a range predicate, which neither a
10,000-year interval nor a key with a third of all rows turns into all pairs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE = 16
SIZES = 6                   # the largest blocks have BASE ** (SIZES - 1) days (2,870 years)

_EPOCH = 719162             # days from 0001-01-01 to 1970-01-01, which makes every day's number positive


def _day(c: Column) -> Column:
    return F.unix_date(c.cast("date")).cast("long") + _EPOCH


def blocks(start: Column, end: Column) -> Column:
    """The blocks ``(size, block)`` that make up the days ``[start, end)``; none if it is empty or NULL."""
    def sized(size: int, some: Column) -> Column:
        return F.transform(some, lambda x: F.struct(F.lit(size).alias("size"), x.alias("block")))
    parts = []
    for size in range(SIZES):
        low, high = F.ceil(start / BASE ** size), F.floor(end / BASE ** size)
        up_low, up_high = F.ceil(start / BASE ** (size + 1)), F.floor(end / BASE ** (size + 1))     # blocks of the next size inside
        inside = (up_low < up_high) if size < SIZES - 1 else F.lit(False)
        for a, b in ((low, F.when(inside, up_low * BASE).otherwise(high)), (F.when(inside, up_high * BASE).otherwise(high), high)):
            parts.append(sized(size, F.when(a < b, F.sequence(a, b - 1)).otherwise(F.array().cast("array<bigint>"))))
    return F.concat(*parts)


def _points(day: Column) -> Column:
    return F.array(*[F.struct(F.lit(s).alias("size"), F.floor(day / BASE ** s).alias("block")) for s in range(SIZES)])


def overlap_join(left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str] = ("valid_from", "valid_to"),
                 overlap: Sequence[str] = ("overlap_from", "overlap_to"), salt_buckets: int = 1, few: int = 32) -> DataFrame:
    """Every pair of rows with equal ``keys`` whose half-open date intervals share a day, once.

    Both sides have the interval in ``columns``; a NULL end is open (to
    9999-12-31), a NULL start or an empty interval overlaps nothing, and a NULL
    key meets nothing. ``keys`` may be empty: then all rows are of one key. The
    result has the keys, the other columns of both sides (which must differ in
    name) and the shared days ``overlap``.

    Keys with at most ``few`` rows on both sides, as histories of a code have,
    are joined by the key alone: their pairs are bounded, and blocks would
    only add rows. Of all others (``few=0``: of all keys)
    the pairs whose right interval starts later (or with the left one) and
    those whose left one does are two equi joins, put together. In each the
    side that gives starts is spread over ``salt_buckets`` where that is asked
    for; otherwise AQE splits a hot block, as both sides are shuffled for the
    join. Rows that pass through: ``SIZES`` per start, at most
    ``2 * BASE * SIZES`` per interval and about a dozen for a usual one.
    """
    start, end = columns
    clash = (set(left.columns) & set(right.columns)) - {*keys, start, end}
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")

    def sides(df: DataFrame, mark: str) -> DataFrame:
        last = F.coalesce(F.col(end).cast("date"), F.lit("9999-12-31").cast("date"))
        rest = [c for c in df.columns if c not in (*keys, start, end)]
        for k in keys:
            df = df.filter(F.col(k).isNotNull())
        return df.select(*keys, F.struct(*[F.col(f"`{c}`") for c in rest]).alias(f"__{mark}"),
                         _day(F.col(start)).alias(f"__{mark}_s"), _day(last).alias(f"__{mark}_e")).filter(
            F.col(f"__{mark}_s") < F.col(f"__{mark}_e"))
    a, b = sides(left, "l"), sides(right, "r")
    usual = None
    if keys and few > 0:
        many = lambda df: df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > few).select(*keys)
        hot = many(a).unionByName(many(b)).distinct()
        light = lambda df: df.join(hot, list(keys), "left_anti")
        usual = light(a).join(light(b), list(keys)).filter("__l_s < __r_e and __r_s < __l_e")
        a, b = a.join(hot, list(keys), "left_semi"), b.join(hot, list(keys), "left_semi")
    on = [*keys, "__size", "__block"] + (["__salt"] if salt_buckets > 1 else [])

    def met(points: DataFrame, p: str, spans: DataFrame, s: str, first: Column) -> DataFrame:
        """Pairs where the start of ``p`` lies in ``[first, end)`` of ``s``."""
        starts = points.withColumn("__b", F.explode(_points(F.col(f"__{p}_s"))))
        ranges = spans.withColumn("__b", F.explode(blocks(first, F.col(f"__{s}_e"))))
        if salt_buckets > 1:
            starts = starts.withColumn("__salt", F.pmod(F.xxhash64(f"__{p}", f"__{p}_s", f"__{p}_e"), F.lit(salt_buckets)))
            ranges = ranges.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salt_buckets - 1).cast("long"))))
        place = [F.col("__b.size").alias("__size"), F.col("__b.block").alias("__block")]
        return starts.select("*", *place).drop("__b").join(ranges.select("*", *place).drop("__b"), on)
    pairs = met(b, "r", a, "l", F.col("__l_s")).unionByName(met(a, "l", b, "r", F.col("__r_s") + 1))
    if usual is not None:
        columns_of = [*keys, "__l", "__l_s", "__l_e", "__r", "__r_s", "__r_e"]
        pairs = usual.select(*columns_of).unionByName(pairs.select(*columns_of))
    date = lambda c: F.date_from_unix_date((c - _EPOCH).cast("int"))
    names = lambda df: [c for c in df.columns if c not in (*keys, start, end)]
    return pairs.select(*keys, *[F.col(f"__l.`{c}`").alias(c) for c in names(left)], *[F.col(f"__r.`{c}`").alias(c) for c in names(right)],
                        date(F.greatest("__l_s", "__r_s")).alias(overlap[0]), date(F.least("__l_e", "__r_e")).alias(overlap[1]))
