"""Shards by minimax contiguous partition of ordered atomic groups.

Documents with equal texts form a group that is never cut.  Groups stand in
the order of their smallest doc_id; shards are runs of that order, and the
largest shard is as small as it can be: the smallest feasible capacity is
found by binary search, a capacity is checked greedily (fill a shard as far as
it goes, then cut), and the greedy cuts of the smallest one are taken.

The greedy check asks only "what is the last group end at or before x?".  The
driver answers from a summary of the running sums - the last group end of each
of ``POINTS`` equal ranges - with a lower and an upper bound where a range
holds more than one end.  Both searches run on those bounds, and as long as
they differ the ranges around the possible cuts are summarised anew, finer
(one aggregation of at most ``POINTS`` rows each).  The answer is exact.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import checkpointed, running_total

SHARDS = 16
POINTS = 1 << 14            # rows of a summary


class Ends:
    """What is known of the group ends: points, and whether nothing lies between a point and the one before it."""

    def __init__(self, total: int):
        self.at, self.sharp = [0, total], [True, False]

    def add(self, found: list[tuple[int, bool]], low: int, high: int) -> None:
        """Replace what is known in ``(low, high]`` by ``found`` (end, alone in its range)."""
        a, b = bisect_right(self.at, low), bisect_right(self.at, high)
        self.at[a:b] = [p for p, _ in found]
        self.sharp[a:b] = [s for _, s in found]

    def last(self, x: int, upper: bool) -> int:
        """The last end at or before ``x``: a lower bound, or an upper bound."""
        i = bisect_right(self.at, x) - 1
        if i == len(self.at) - 1 or self.at[i] == x or self.sharp[i + 1]:
            return self.at[i]
        return x if upper else self.at[i]

    def cuts(self, capacity: int, shards: int, upper: bool) -> list[int]:
        at, cuts = 0, []
        for _ in range(shards):
            at = self.last(at + capacity, upper)
            cuts.append(at)
        return cuts

    def smallest(self, low: int, shards: int, upper: bool) -> int:
        """Smallest capacity from ``low`` on whose greedy cuts reach the end (binary search)."""
        total = self.at[-1]
        a, b = low, total
        while a < b:
            mid = (a + b) // 2
            if self.cuts(mid, shards, upper)[-1] >= total:
                b = mid
            else:
                a = mid + 1
        return a

    def blurred(self, low: int, high: int) -> tuple[int, int] | None:
        """The known points around ``low .. high`` if an unknown end may lie between them."""
        a = bisect_right(self.at, low) - 1
        b = bisect_left(self.at, high)
        while a < b and self.sharp[a + 1]:
            a += 1
        while a < b and self.sharp[b]:
            b -= 1
        return (self.at[a], self.at[b]) if a < b else None


def minimax_cuts(groups: DataFrame, end: str, size: str, shards: int, points: int = POINTS) -> list[int]:
    """The ends of the shards, as running sums; the last one is the total."""
    total, largest = groups.agg(F.max(end), F.max(size)).first()
    if not total:
        return [0] * shards
    known, least = Ends(total), max(largest, -(-total // shards))
    windows = [(0, total)]
    while windows:
        each = max(2, points // len(windows))
        which, bucket = F.lit(None).cast("int"), F.lit(None).cast("long")
        for w, (low, high) in enumerate(windows):
            inside, width = (F.col(end) > low) & (F.col(end) <= high), -(-(high - low) // each)
            which = F.when(inside, F.lit(w)).otherwise(which)
            bucket = F.when(inside, F.expr(f"(`{end}` - {low + 1}L) div {width}L")).otherwise(bucket)
        rows = (groups.select(F.col(end).alias("_end"), which.alias("_w"), bucket.alias("_b")).where("_w is not null")
                .groupBy("_w", "_b").agg(F.max("_end").alias("e"), F.count("*").alias("n")).orderBy("_w", "_b").collect())
        for w, (low, high) in enumerate(windows):
            known.add([(r["e"], r["n"] == 1) for r in rows if r["_w"] == w], low, high)
        best, worst = known.smallest(least, shards, True), known.smallest(least, shards, False)
        reach = zip(known.cuts(best, shards, False), known.cuts(worst, shards, True))
        unclear = sorted({w for low, high in reach if (w := known.blurred(low, min(high, total)))})
        windows = []
        for low, high in unclear:
            if windows and low <= windows[-1][1]:
                windows[-1] = (windows[-1][0], max(high, windows[-1][1]))
            else:
                windows.append((low, high))
        if best == worst and known.cuts(best, shards, True) == known.cuts(best, shards, False):
            return known.cuts(best, shards, False)
    raise AssertionError("bounds of the greedy cuts differ although every end near them is known")


def shard(docs: DataFrame, n_shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text",
          points: int = POINTS) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every row.

    ``size`` is the text's UTF-8 bytes plus 1; a null text counts as none (crc32
    0), and null texts form one group apart from empty ones.  Within a shard
    ``slot`` follows the groups' order, then doc_id; repeated rows each get a
    slot.  A group larger than an even share makes its shard larger, because
    groups are atomic.  An empty table gives no rows; fewer groups than shards
    leave shards empty.  Only summaries reach the driver.
    """
    text = F.col(text_col).cast("string")
    key: Column = F.coalesce(F.unhex(F.sha2(text.cast("binary"), 256)), F.lit("").cast("binary"))
    rows = checkpointed(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"), key.alias("key")))
    groups = rows.groupBy("key").agg(F.min("doc_id").alias("first"), F.sum("size").alias("bytes"))
    placed = running_total(groups, ["first", "key"], F.col("bytes"), "before")
    placed = checkpointed(placed.select("key", "first", "bytes", "before", (F.col("before") + F.col("bytes")).alias("end")))
    cuts = minimax_cuts(placed, "end", "bytes", n_shards, points)
    number = sum(((F.col("before") >= c).cast("int") for c in cuts[:-1]), F.lit(0))
    of_group = placed.select("key", "first", number.alias("shard"))
    dealt = rows.join(of_group, "key")
    slots = running_total(dealt, ["first", "key", "doc_id"], F.lit(1), "slot", by=["shard"])
    return slots.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                        F.lit(None).cast("int").alias("grown_shard"))
