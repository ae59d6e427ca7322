"""Best-fit packing planned on the histogram of lengths.

The plan never looks at documents: best-fit decreasing runs over the counts of
the at most ``capacity`` distinct lengths, moving whole groups of equal bins at
a time.  Documents then take the planned slots by their rank within their
length.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import checkpointed

CAPACITY = 2048
PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long, part int, local_rank long"


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Best-fit decreasing over counts.

    Returns ``(length, first_rank, n, first_sequence, offset)`` rows - ranks
    ``first_rank .. first_rank + n - 1`` of a length go to that many
    consecutive sequences, at ``offset`` - and the number of sequences.  Bins
    with the same room are one run of sequence numbers, so the plan depends on
    the number of distinct lengths and not on the number of documents.
    """
    rooms: dict[int, list[tuple[int, int]]] = {}     # room -> runs (first sequence, number of sequences)
    open_rooms: list[int] = []                       # sorted keys of ``rooms``
    rows, n_sequences = [], 0

    def give(room: int, run: tuple[int, int]) -> None:
        if room not in rooms:
            rooms[room] = []
            bisect.insort(open_rooms, room)
        rooms[room].append(run)
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect.bisect_left(open_rooms, length)
            if at == len(open_rooms):                # new sequences: each takes as many of this length as fit
                fit = min(capacity // length, left)
                n = left // fit
                for k in range(fit):
                    rows.append((length, rank, n, n_sequences, k * length))
                    rank += n
                give(capacity - fit * length, (n_sequences, n))
                n_sequences, left = n_sequences + n, left - fit * n
                continue
            room = open_rooms[at]                    # the least room that still fits
            first, n = rooms[room].pop()
            if not rooms[room]:
                del rooms[room]
                open_rooms.pop(at)
            used = min(n, left)
            rows.append((length, rank, used, first, capacity - room))
            rank, left = rank + used, left - used
            give(room - length, (first, used))
            if used < n:
                give(room, (first + used, n - used))
    return rows, n_sequences


def pieces(docs: DataFrame, make_encoder: Callable[[], Callable[[str | None], bytes]], end_id: int,
           capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece of at most ``capacity`` ids, with its rank among the pieces of its length in its task."""
    end = end_id.to_bytes(4, "little")

    def run(batches):
        encode, part, seen = make_encoder(), TaskContext.get().partitionId(), {}
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encode(text) + end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    cut = ids[at:at + 4 * capacity]
                    n = len(cut) // 4
                    rank = seen.get(n, 0)
                    seen[n] = rank + 1
                    out.append((doc_id, k, at // 4, n, zlib.crc32(cut), part, rank))
            columns = list(zip(*out)) or [[]] * 7
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                             names=[f.split()[0] for f in PIECES.split(", ")])
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, PIECES)


def pack(docs: DataFrame, make_encoder: Callable[[], Callable[[str | None], bytes]], end_id: int,
         capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every piece with its ``sequence_id`` and its ``offset`` in it.

    A document is its ids and the end id; only a document longer than
    ``capacity`` is cut.  Null and empty texts are the end id alone; repeated
    rows are packed as often as they come; an empty table gives no rows.  The
    pieces (no text, no ids) are checkpointed, so ranks stay as they are if an
    executor is lost.  The histogram (at most ``capacity`` rows) and the plan
    made from it are all that the driver sees.
    """
    found = checkpointed(pieces(docs, make_encoder, end_id, capacity, id_col, text_col))
    per_part = found.groupBy("length", "part").agg(F.max("local_rank").alias("last"))
    per_part = per_part.select("length", "part", (F.col("last") + 1).alias("n"))
    counts = {r["length"]: r["n"] for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    rows, _ = plan(counts, capacity)
    by_length: dict[int, list[tuple]] = {}
    for length, *slot in rows:
        by_length.setdefault(length, []).append(slot)
    slots = {n: np.array(s, dtype=np.int64).reshape(-1, 4) for n, s in by_length.items()}
    shared = docs.sparkSession.sparkContext.broadcast(slots)

    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first_rank"))
    ranked = found.join(offsets, ["length", "part"]).select(
        "doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32",
        (F.col("first_rank") + F.col("local_rank")).alias("rank"))

    def place(batches):
        for batch in batches:
            lengths, ranks = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            sequence, offset = np.empty(len(ranks), np.int64), np.empty(len(ranks), np.int64)
            for n in np.unique(lengths):
                at, table = np.flatnonzero(lengths == n), shared.value[int(n)]
                row = table[np.searchsorted(table[:, 0], ranks[at], side="right") - 1]
                sequence[at], offset[at] = row[:, 2] + ranks[at] - row[:, 0], row[:, 3]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])
    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, "
                                    "sequence_id long, offset long")
