"""Stupid-backoff scores of order 2 or 3, computed relationally.

``S(w2 | w1) = c(w1 w2) / c(w1)`` if the pair is in the count table (seen
``least`` times or more), else ``BACKOFF * c(w2) / N``; the first word of a
text scores ``c(w) / N``.  A text's score is the sum of the logarithms.

Order 3 has two words of context, ``S(w3 | w1 w2) = c(w1 w2 w3) / c(w1 w2)``,
else ``BACKOFF * S(w3 | w2)``, and keeps all counts.  The scores of a text's
first two words, ``c(w1) / N`` and ``c(w1 w2) / c(w1)``, make ``c(w1 w2) / N``
together.  So a "pair" below is a context of two words, known by a 64-bit hash,
and the word after it, and the pair (context, ``OPEN``) asks for the context's
own count.

By counts that cover a text itself all its n-grams are in the tables of order 3.
Documents that are held out are scored a second time, by the counts of all
others: their n-grams back off from three words to two and to one, by
``BACKOFF`` each, and a word that no other document has scores ``BACKOFF / N``.
Their n-grams travel with the others; what backs off goes on to the bucket of
the shorter n-gram.

Counts cover all documents.  Documents are exploded to n-grams block by block:
each task turns some thousands of documents into one row per hash bucket that
holds the distinct pairs of the block, their counts, and which documents have
them.  Pairs are bucketed by their first word, so a bucket knows ``c(w1)`` and
``c(w1 w2)``; words so frequent that one bucket would hold too much (at most
``HOT`` of them, by their share of all words) are spread by the whole pair, and
their counts go along as a small table.  A bucket's task counts the pairs of its
block rows, ``SLICE_PAIRS`` at a time; pairs that back off go on, by their second
word, to the buckets of the word count table.  What a task yields is one vector
of sums for each block of documents, so no row per document and n-gram is
shuffled.  Within a row pairs ascend, so that first words are kept as differences
and second ones as places in the row's list of words; all columns are compressed.
"""

from __future__ import annotations

import pickle
import tempfile
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import checkpointed

LEAST = 2                   # occurrences of a pair in the count table of order 2, unless told otherwise
OPEN = 1                    # in place of a second word: a text opens with this context
BACKOFF = 0.4
HOT = 1000                  # a word is hot if it is one of HOT words or more
BLOCK_WORDS = 5 << 17       # words of a block of documents
PIECE_BYTES = 1 << 20       # bytes of text that are split into words at once
WORD_BYTES = 64             # of a word that are hashed together with other words; longer ones are hashed alone
BUCKET_BYTES = 16 << 20     # bytes of text per bucket of order 2; half as many at order 3
HELD_BYTES = 64 << 20      # of a bucket's rows that a task holds in memory
SLICE_PAIRS = 1 << 19       # pairs of a bucket that are counted at once
PENDING_BYTES = 64 << 20    # sums that a task holds before it passes them on
PENDING_NEEDS = 1 << 19     # backed-off n-grams that a task holds before it passes them on
UNIT = 2.0 ** 32            # sums travel as whole numbers of 1 / UNIT
# ``docs`` (ids, whether known, words) comes with one row of a block; ``doc`` counts within the block.
# From ``n_main`` on, documents of a block are held out; ``mid``: the middle words of their pairs, ``also``: their second words.
PAIRS = ("bucket int, block long, n_docs int, n_main int, docs binary, w1 binary, words binary, w2 binary, n binary, refs binary, "
         "doc binary, times binary, mid binary, also binary")
NEEDS = ("bucket int, kind int, block long, held boolean, docs binary, w binary, mid binary, last binary, blocks binary, doc binary, "
         "times binary, sums binary")
SUMS = "block long, held boolean, docs binary, sums binary"
CONTEXTS, SHORTER, WORDS, TOTALS = 1, 2, 3, 4       # kinds of needs: counts of contexts, n-grams of two words, words, sums


SOLID = np.ones(256, bool)
SOLID[[*b" \t\n\r\x0b\x0c"]] = False
SPREAD = np.uint64(0x9E3779B97F4A7C15)
FIRST_BYTES = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)


def _mix(h: np.ndarray) -> np.ndarray:
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(29)
    return h


def _word_hashes(texts: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """48-bit hashes, never 0 or ``OPEN``, of the lower-cased (A-Z) words between ASCII white space; how many each text has."""
    at = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    if at[0] == at[-1]:
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    text = texts.buffers()[2].slice(at[0], at[-1] - at[0]).to_pybytes().lower() + bytes(8)
    at -= at[0]
    solid = SOLID[np.frombuffer(text, np.uint8)[:-8]]
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    filled = at[:-1] < at[1:]                               # a word does not go on in the next text
    opens, ends = at[:-1][filled], at[1:][filled] - 1
    first[opens], last[ends] = solid[opens], solid[ends]
    starts = np.flatnonzero(first)
    sizes = np.flatnonzero(last) + 1 - starts
    eight = np.ndarray(len(solid), "<u8", text, strides=(1,))       # the eight bytes from each place on
    h = _mix(eight[starts] & FIRST_BYTES[np.minimum(sizes, 8)]) ^ sizes.astype(np.uint64) * SPREAD
    for k in range(8, WORD_BYTES, 8):
        on = np.flatnonzero(sizes > k)
        h[on] = _mix(h[on] * SPREAD ^ eight[starts[on] + k] & FIRST_BYTES[np.minimum(sizes[on] - k, 8)])
    for i in np.flatnonzero(sizes > WORD_BYTES).tolist():
        h[i] = xxhash.xxh64_intdigest(text[starts[i]:starts[i] + sizes[i]])
    return np.maximum(h >> np.uint64(16), np.uint64(2)), np.diff(np.searchsorted(starts, at))


def _documents(batches) -> Iterator[tuple[int | None, bool, np.ndarray]]:
    """``doc_id, held, word hashes`` of each row."""
    for batch in batches:
        ids, held = batch.column(0).to_pylist(), batch.column(2).to_pylist()
        texts = batch.column(1).cast(pa.binary()).fill_null(b"")
        ends, at = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)), 0
        while at < len(ids):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PIECE_BYTES, side="right")))
            found, n = _word_hashes(texts.slice(at, to - at))
            yield from zip(ids[at:to], held[at:to], np.split(found, np.cumsum(n)[:-1]))
            at = to


def _blocks(batches) -> Iterator[tuple[list, list[np.ndarray], int]]:
    """``(doc_ids, word hashes of each document, number of documents not held out)`` in blocks of about ``BLOCK_WORDS`` words;
    held-out documents come last."""
    ids, docs, n = ([], []), ([], []), 0
    for doc_id, held, found in _documents(batches):
        ids[held].append(doc_id)
        docs[held].append(found)
        n += len(found)
        if n >= BLOCK_WORDS:
            yield ids[0] + ids[1], docs[0] + docs[1], len(ids[0])
            ids, docs, n = ([], []), ([], []), 0
    if ids[0] or ids[1]:
        yield ids[0] + ids[1], docs[0] + docs[1], len(ids[0])


def _bucket(w: np.ndarray, n: int) -> np.ndarray:
    return ((w >> np.uint64(17)) % np.uint64(n)).astype(np.int32)


def _places(table: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each ``w`` in the sorted table, and whether it is there."""
    if not len(table):
        return np.zeros(len(w), np.int64), np.zeros(len(w), bool)
    at = np.minimum(np.searchsorted(table, w), len(table) - 1)
    return at, table[at] == w


def _pair_keys(w1: np.ndarray, w2: np.ndarray, spread: np.ndarray, order: int) -> np.ndarray:
    """64-bit keys by which pairs are dealt to buckets and ordered in them: that of the first word, of the pair if it is spread."""
    return np.where(_places(spread, w1)[1], w1 ^ (w2 * SPREAD), w1 << np.uint64(16) if order == 2 else w1)


def _order(key: np.ndarray, *more: np.ndarray) -> np.ndarray:
    """Places of the rows in the order of ``key`` and ``more``, which are sorted among equal keys alone."""
    order = np.argsort(key)
    found = key[order]
    same = np.r_[False, found[1:] == found[:-1], False]
    tied = np.flatnonzero(same[1:] | same[:-1])
    if len(tied):
        places = order[tied]
        order[tied] = places[np.lexsort((*(m[places] for m in more[::-1]), found[tied]))]
    return order


def _contexts(w1: np.ndarray, w2: np.ndarray) -> np.ndarray:
    """64-bit hash of two words, never 0."""
    h = w1 * np.uint64(0x9E3779B97F4A7C15) + w2 * np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return np.maximum(h, np.uint64(1))


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal rows in sorted key columns."""
    change = np.zeros(len(keys[0]), bool)
    change[:1] = True
    for k in keys:
        change[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(change)


def _sizes(starts: np.ndarray, n: int) -> np.ndarray:
    return np.diff(np.r_[starts, n])


def _pack(a: np.ndarray) -> bytes:
    return a.tobytes()


def _squeeze(a: np.ndarray) -> bytes:
    """Numbers byte by byte, the first byte of all before the second, compressed."""
    planes = np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.itemsize).T.tobytes()
    return len(a).to_bytes(4, "little") + pa.compress(planes, "zstd", asbytes=True) if len(a) else b""


def _unfold(b: bytes, kind: type) -> np.ndarray:
    if not b:
        return np.zeros(0, kind)
    n, size = int.from_bytes(b[:4], "little"), np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(b[4:], n * size, "zstd", asbytes=True), np.uint8).reshape(size, n)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _pack_sums(a: np.ndarray) -> bytes:
    return _squeeze(np.rint(a * -UNIT).astype(np.int64))


def _unpack_sums(b: bytes) -> np.ndarray:
    return _unfold(b, np.int64) / -UNIT


def _flat(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def _counts(every: np.ndarray, held: np.ndarray) -> pa.RecordBatch:
    """``w, c, t``: how often each value comes, and how often without those of held-out documents."""
    w, c = np.unique(every, return_counts=True)
    t = c.copy()
    h, n = np.unique(held, return_counts=True)
    t[np.searchsorted(w, h)] -= n
    return pa.RecordBatch.from_arrays([pa.array(w.view(np.int64)), pa.array(c), pa.array(t)], names=["w", "c", "t"])


def _doc_kind(n_docs: int) -> type:
    return np.uint16 if n_docs <= 1 << 16 else np.uint32


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary(), "long": pa.int64(), "double": pa.float64()}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows)) or [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], names=[n for n, _ in fields])


class _Sums:
    """Sums per document of several blocks (of the held-out ones apart), passed on when they take too much room."""

    def __init__(self):
        self.of: dict[tuple[int, bool], np.ndarray] = {}
        self.docs: dict[tuple[int, bool], bytes] = {}
        self.single: dict[bool, list[tuple[np.ndarray, ...]]] = {False: [], True: []}
        self.bytes = 0

    def add(self, block: int, held: bool, values: np.ndarray, docs: bytes = b"") -> None:
        key = block, held
        self.bytes -= 8 * len(self.of.get(key, ()))
        self.of[key] = _plus(self.of.get(key), values)
        self.bytes += 8 * len(self.of[key])
        if docs:
            self.docs[key] = docs

    def add_single(self, held: bool, blocks: np.ndarray, doc: np.ndarray, values: np.ndarray) -> None:
        """A value for each of some documents of any blocks."""
        self.single[held].append((blocks, doc, values))
        self.bytes += 24 * len(doc)

    def take(self) -> Iterator[tuple[int, bool, np.ndarray, bytes]]:
        for held, parts in self.single.items():
            if parts:
                blocks, doc, values = (np.concatenate(x) for x in zip(*parts))
                order = np.argsort(blocks, kind="stable")
                blocks, doc, values = blocks[order], doc[order], values[order]
                edges = np.r_[_runs(blocks), len(blocks)].tolist()
                for lo, hi in zip(edges, edges[1:]):
                    self.add(int(blocks[lo]), held, np.bincount(doc[lo:hi], values[lo:hi]))
        for (block, held), values in self.of.items():
            yield block, held, values, self.docs.get((block, held), b"")
        self.of, self.docs, self.single, self.bytes = {}, {}, {False: [], True: []}, 0

    def needs(self, buckets: int) -> Iterator[pa.RecordBatch]:
        """The sums as rows that all tasks send to one bucket for a block."""
        for block, held, values, docs in self.take():
            yield _batch([(zlib.crc32(str(block).encode()) % buckets, TOTALS, block, held, docs, b"", b"", b"", b"", b"", b"",
                           _pack_sums(values))], NEEDS)


def _plus(a: np.ndarray | None, b: np.ndarray) -> np.ndarray:
    """Sums of which the shorter one has zeros at its end."""
    if a is None or len(a) < len(b):
        a, b = np.array(b, dtype=np.float64), a if a is not None else b[:0]
    a[:len(b)] += b
    return a


class _Needs:
    """Backed-off n-grams of a task, passed on as one row for each bucket, kind and whether held out."""

    def __init__(self, buckets: int):
        self.buckets, self.of, self.n = buckets, {}, 0

    def add(self, kind: int, held: bool, blocks: np.ndarray | int, doc: np.ndarray, times: np.ndarray, w: np.ndarray,
            mid: np.ndarray | None = None, last: np.ndarray | None = None) -> None:
        """``mid`` and ``last``: of n-grams of two words, where ``w`` is the hash of both."""
        none = np.zeros(0, np.uint64)
        self.of.setdefault((kind, held), []).append((np.broadcast_to(np.asarray(blocks, np.int64), len(w)), doc.astype(np.uint32),
                                                     times.astype(np.int32), w, none if mid is None else mid, none if last is None else last))
        self.n += len(w)

    def take(self) -> Iterator[pa.RecordBatch]:
        for (kind, held), parts in self.of.items():
            columns = [np.concatenate(x) for x in zip(*parts)]
            bucket = _bucket(columns[3], self.buckets)
            order = np.argsort(bucket, kind="stable")
            bucket = bucket[order]
            columns, edges, rows = [c[order] if len(c) else c for c in columns], np.r_[_runs(bucket), len(bucket)].tolist(), []
            for lo, hi in zip(edges, edges[1:]):
                blocks, doc, times, w, mid, last = (_squeeze(c[lo:hi]) for c in columns)
                rows.append((int(bucket[lo]), kind, 0, held, b"", w, mid, last, blocks, doc, times, b""))
            for at in range(0, len(rows), 64):
                yield _batch(rows[at:at + 64], NEEDS)
        self.of, self.n = {}, 0


def word_counts(docs: DataFrame) -> DataFrame:
    """``w, c, t``: occurrences of every word hash, and those not in held-out documents, combined per block before the shuffle."""
    def run(batches):
        for _, parts, n_main in _blocks(batches):
            found = _counts(_flat(parts), _flat(parts[n_main:]))
            for at in range(0, found.num_rows, 1 << 16):
                yield found.slice(at, 1 << 16)
    return docs.mapInArrow(run, "w long, c long, t long").groupBy("w").agg(F.sum("c").alias("c"), F.sum("t").alias("t"))


def context_counts(docs: DataFrame, hot: np.ndarray) -> DataFrame:
    """``w, c, t``: occurrences of the contexts of two words that are both in ``hot``, and those not in held-out documents."""
    def run(batches):
        for _, parts, n_main in _blocks(batches):
            flat = np.concatenate(parts)
            known = hot[np.minimum(np.searchsorted(hot, flat), len(hot) - 1)] == flat
            ends = np.cumsum([len(p) for p in parts])
            both = known & np.r_[known[1:], np.zeros(min(1, len(flat)), bool)]
            both[ends[ends > 0] - 1] = False                     # the last word of a document
            both = np.flatnonzero(both)
            contexts = _contexts(flat[both], flat[both + 1])
            yield _counts(contexts, contexts[both >= (ends[n_main - 1] if n_main else 0)])
    return docs.mapInArrow(run, "w long, c long, t long").groupBy("w").agg(F.sum("c").alias("c"), F.sum("t").alias("t"))


def _pairs(parts: list[np.ndarray], lengths: np.ndarray) -> tuple[np.ndarray, ...]:
    """``w1, w2, doc, mid, also`` of all pairs of order 2, where nothing is in the middle."""
    none = np.zeros(1, np.uint64)
    edged = [np.concatenate([none, p, none]) for p in parts if len(p)]
    flat = np.concatenate(edged) if edged else none
    w1, w2 = flat[:-1], flat[1:]
    inside = (w1 != 0) | (w2 != 0)                       # not the seam between two documents
    w1, w2 = w1[inside], w2[inside]
    return w1, w2, np.repeat(np.arange(len(parts), dtype=np.uint32), np.where(lengths > 0, lengths + 1, 0)), w1, w1


def _triples(parts: list[np.ndarray], lengths: np.ndarray) -> tuple[np.ndarray, ...]:
    """``w1, w2, doc, mid, also`` of order 3, ``w1`` a context; a text of one word has the pair (0, word) only.

    ``mid`` is the second word of the context; where ``w2`` is ``OPEN``, ``mid`` and ``also`` are its first and second one.
    """
    flat = _flat(parts)
    doc = np.repeat(np.arange(len(parts), dtype=np.uint32), lengths)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    after = np.r_[flat[1:], np.zeros(min(1, len(flat)), np.uint64)]
    after[place + 1 == lengths[doc]] = 0
    second = np.flatnonzero(place >= 1)
    context = _contexts(flat[second - 1], flat[second])
    opens, single = place[second] == 1, lengths[doc] == 1
    return (np.concatenate([context, context[opens], np.zeros(single.sum(), np.uint64)]),
            np.concatenate([after[second], np.full(opens.sum(), OPEN, np.uint64), flat[single]]),
            np.concatenate([doc[second], doc[second][opens], doc[single]]),
            np.concatenate([flat[second], flat[second - 1][opens], flat[single]]),
            np.concatenate([flat[second], flat[second][opens], flat[single]]))


def pair_blocks(docs: DataFrame, hot: np.ndarray, buckets: int, order: int = 2) -> DataFrame:
    """One row per block and bucket: the block's distinct pairs of the bucket and the documents that have them.

    The pair (0, first word) opens a document; the pair (last word, 0) closes
    it: that one counts for its word and is not scored.
    """
    pairs_of = _pairs if order == 2 else _triples
    spread = np.union1d(hot, np.zeros(1, np.uint64))

    def run(batches):
        part = TaskContext.get().partitionId()
        for seq, (ids, parts, n_main) in enumerate(_blocks(batches)):
            n_docs, lengths = len(ids), np.array([len(p) for p in parts], np.int64)
            w1, w2, doc, mid, also = pairs_of(parts, lengths)
            key = _pair_keys(w1, w2, spread, order)
            by = _order(key, w1, w2, doc)
            bucket = ((key[by] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)
            w1, w2, doc = w1[by], w2[by], doc[by]
            ref = _runs(bucket, w1, w2, doc)                     # one entry per pair and document
            times = _sizes(ref, len(doc)).astype(np.uint32)
            bucket, w1, w2, doc = bucket[ref], w1[ref], w2[ref], doc[ref].astype(_doc_kind(n_docs))
            pair = _runs(bucket, w1, w2)
            refs = _sizes(pair, len(doc)).astype(np.uint32)
            n = np.add.reduceat(times, pair).astype(np.uint32) if len(pair) else np.zeros(0, np.uint32)
            w1, w2, bucket = w1[pair], w2[pair], bucket[pair]
            edges, rows = np.r_[0, np.cumsum(refs)], []
            held = doc[edges[1:] - 1] >= n_main                  # a pair's documents ascend: some of them is held out
            first = by[ref[pair]]
            mid, also = mid[first], also[first]
            told = (_pack(np.array([-1 if i is None else i for i in ids], np.int64))
                    + _pack(np.array([i is not None for i in ids], np.uint8)) + _pack(lengths) + _pack(np.array([n_main])))
            name = (part << 32) + seq
            for b in np.unique(bucket).tolist() or [0]:
                lo, hi = np.searchsorted(bucket, [b, b + 1])
                e = slice(edges[lo], edges[hi])
                more = held[lo:hi] & (order == 3)
                own, code = np.unique(w2[lo:hi], return_inverse=True)
                rows.append((b, name, n_docs, n_main, b"" if rows else told, _squeeze(np.diff(w1[lo:hi], prepend=np.uint64(0))),
                             _squeeze(np.diff(own, prepend=np.uint64(0))), _squeeze(code.astype(_doc_kind(len(own)))), _squeeze(n[lo:hi]),
                             _squeeze(refs[lo:hi]), _squeeze(doc[e]), _squeeze(times[e]), _squeeze(mid[lo:hi][more]),
                             _squeeze(also[lo:hi][more & (w2[lo:hi] == OPEN)])))
            for at in range(0, len(rows), 64):
                yield _batch(rows[at:at + 64], PAIRS)
    return docs.mapInArrow(run, PAIRS)


def _read_pairs(row: dict) -> dict:
    """A row of ``pair_blocks`` with its columns as arrays; ``w2`` stays with ``words``, see ``_second``."""
    words = np.cumsum(_unfold(row["words"], np.uint64), dtype=np.uint64)
    kinds = {"w2": _doc_kind(len(words)), "n": np.uint32, "refs": np.uint32, "doc": _doc_kind(row["n_docs"]), "times": np.uint32,
             "mid": np.uint64, "also": np.uint64}
    w1 = np.cumsum(_unfold(row["w1"], np.uint64), dtype=np.uint64)
    return {**row, "w1": w1, "words": words} | {k: _unfold(row[k], v) for k, v in kinds.items()}


def _second(row: dict, lo: int = 0, hi: int | None = None) -> np.ndarray:
    return row["words"][row["w2"][lo:hi]]


def _context_sums(first: np.ndarray, n: np.ndarray, opens: np.ndarray) -> np.ndarray:
    return np.repeat(np.add.reduceat(np.where(opens, 0, n), first), _sizes(first, len(n))) if len(n) else n


def _pair_logs(w1: np.ndarray, w2: np.ndarray, n: np.ndarray, t: np.ndarray, out: np.ndarray, hot: np.ndarray, hot_counts: np.ndarray,
               hot_others: np.ndarray, least: int, total: int, others: int):
    """``log(c(w1 w2) / c(w1))`` of each given pair, if it is seen ``least`` times in all rows together, else nan; ``log(c(w1) / N)``
    where w2 is ``OPEN``.  ``n``: how often a row has the pair, ``t``: in documents that are not held out, ``out``: in others, too.

    Then the same by the documents that are not held out (minus infinity: not seen ``least`` times there), and the first
    words that held-out documents have too, with their counts in these.
    """
    order = _order(w1, w2)
    a, b = w1[order], w2[order]
    pair = _runs(a, b)
    sizes, a, b = _sizes(pair, len(a)), a[pair], b[pair]
    n, t = (np.add.reduceat(x[order], pair) if len(pair) else x for x in (n, t))
    first, opens = _runs(a), b == OPEN
    context, rest = _context_sums(first, n, opens), _context_sums(first, t, opens)
    at, is_hot = _places(hot, a)
    if len(hot):
        context, rest = (np.where(is_hot, h[at], c) for h, c in ((hot_counts, context), (hot_others, rest)))
    keep = (n >= least) & (a != 0) & (b != 0)
    share = np.where(opens, context / max(total, 1), n / np.maximum(context, 1))
    known = keep & (np.where(opens, rest, t) >= least)
    share_others = np.where(known, np.where(opens, rest / max(others, 1), t / np.maximum(rest, 1)), 0)
    logs = np.full(len(w1), np.nan), np.full(len(w1), -np.inf)
    with np.errstate(divide="ignore"):
        logs[0][order] = np.repeat(np.where(keep, np.log(share), np.nan), sizes)
        logs[1][order] = np.repeat(np.log(share_others), sizes)
    asked = np.logical_or.reduceat(np.logical_or.reduceat(out[order], pair), first) if len(pair) else out
    seen = first[asked & (rest[first] > 0)]
    return *logs, a[seen], rest[seen]


class _Held:
    """The rows of a bucket, to be read twice; beyond ``HELD_BYTES`` they go to a temporary file of the task."""

    def __init__(self):
        self.rows, self.bytes, self.file = [], 0, None

    def add(self, row: dict) -> None:
        self.rows.append(row)
        self.bytes += sum(v.nbytes for v in row.values() if isinstance(v, np.ndarray))
        if self.bytes > HELD_BYTES:
            self.file = self.file or tempfile.TemporaryFile()
            pickle.dump(self.rows, self.file)
            self.rows, self.bytes = [], 0

    def __iter__(self) -> Iterator[dict]:
        if self.file:
            end = self.file.tell()
            self.file.seek(0)
            while self.file.tell() < end:
                yield from pickle.load(self.file)
        yield from self.rows

    def close(self) -> None:
        if self.file:
            self.file.close()


def _pair_scores(buckets: int, hot: np.ndarray, hot_counts: np.ndarray, hot_others: np.ndarray, least: int, total: int, others: int,
                 order: int):
    """Buckets, sorted: the pairs of a bucket's rows are counted, then each row is scored.

    Sums of the pairs that are in the table stay with their documents; the
    others go on to the bucket of their second word.
    """
    spread = np.union1d(hot, np.zeros(1, np.uint64))

    def run(batches):
        sums, needs, held, now = _Sums(), _Needs(buckets), None, None
        for batch in batches:
            for at in range(0, batch.num_rows, 16):
                for row in batch.slice(at, 16).to_pylist():
                    if row["bucket"] != now:
                        if held:
                            yield from scored(held, sums, needs)
                        held, now = _Held(), row["bucket"]
                    held.add(_read_pairs(row))
        if held:
            yield from scored(held, sums, needs)
        yield from needs.take()
        yield from sums.needs(buckets)

    def cut(held) -> np.ndarray:
        """For each row where its slices begin and end; a first word that is not spread is in one slice."""
        n = [len(row["w1"]) for row in held]
        slices = -(-sum(n) // SLICE_PAIRS)
        if slices <= 1:
            return np.array([[0, k] for k in n])
        some = np.sort(np.concatenate([_pair_keys(row["w1"][::64], row["words"][row["w2"][::64]], spread, order) for row in held]))
        bounds = some[np.arange(1, slices) * len(some) // slices]
        return np.array([np.r_[0, np.searchsorted(_pair_keys(row["w1"], _second(row), spread, order), bounds), k] for row, k in zip(held, n)])

    def scored(held, sums, needs):
        cuts = cut(held)
        logs = [(np.empty(k), np.empty(k)) for k in cuts[:, -1].tolist()]
        for lows, highs in zip(cuts.T[:-1], cuts.T[1:]):
            parts = [slice_of(row, lo, hi) for row, lo, hi in zip(held, lows.tolist(), highs.tolist())]
            share, share_others, contexts, context_n = _pair_logs(*(np.concatenate(x) for x in zip(*parts)), hot, hot_counts, hot_others, least,
                                                                  total, others)
            at = 0
            for (mine, by_others), lo, hi in zip(logs, lows.tolist(), highs.tolist()):
                mine[lo:hi], by_others[lo:hi] = share[at:at + hi - lo], share_others[at:at + hi - lo]
                at += hi - lo
            if len(contexts) and order == 3:
                bucket = _bucket(contexts, buckets)
                by = np.argsort(bucket, kind="stable")
                bucket, contexts, context_n = bucket[by], contexts[by], context_n[by]
                edges = np.r_[_runs(bucket), len(bucket)].tolist()
                yield _batch([(int(bucket[a]), CONTEXTS, 0, True, b"", _squeeze(contexts[a:b]), b"", b"", b"", b"", _squeeze(context_n[a:b]), b"")
                              for a, b in zip(edges, edges[1:])], NEEDS)
        del cuts
        for row, (share, share_others) in zip(held, logs):
            n_docs, w2, refs, times, doc = row["n_docs"], _second(row), row["refs"], row["times"], row["doc"]
            lacking = np.isnan(share)
            value = np.where(lacking, np.where((w2 != 0) & (row["w1"] != 0), np.log(BACKOFF), 0.0), share)
            sums.add(row["block"], False, np.bincount(doc, np.repeat(value, refs) * times, minlength=n_docs), row["docs"])
            if row["n_main"] < n_docs:
                held_out(row, sums, needs, w2, share_others)
            back = np.repeat((w2 != 0) & lacking, refs)
            if back.any():
                needs.add(WORDS, False, row["block"], doc[back], times[back], np.repeat(w2, refs)[back])
            if needs.n > PENDING_NEEDS:
                yield from needs.take()
            if sums.bytes > PENDING_BYTES:
                yield from sums.needs(buckets)
        held.close()

    def slice_of(row, lo, hi):
        """``w1, w2, n, t, out`` of some of a row's pairs, see ``_pair_logs``."""
        n = row["n"][lo:hi].astype(np.int64)
        t, out = n, np.zeros(len(n), bool)
        if row["n_main"] < row["n_docs"] and len(n):
            edges = np.r_[0, np.cumsum(row["refs"], dtype=np.int64)][lo:hi + 1]
            entry = slice(edges[0], edges[-1])
            held = np.add.reduceat(np.where(row["doc"][entry] >= row["n_main"], row["times"][entry], 0).astype(np.int64), edges[:-1] - edges[0])
            t, out = n - held, held > 0
        return row["w1"][lo:hi], _second(row, lo, hi), n, t, out

    def held_out(row, sums, needs, w2, share_others):
        """The row's held-out documents by the counts of the others."""
        block, w1, refs, n_docs = row["block"], row["w1"], row["refs"], row["n_docs"] - row["n_main"]
        entry = np.flatnonzero(row["doc"] >= row["n_main"])
        if not len(entry):
            return
        pair = np.repeat(np.arange(len(refs)), refs)[entry]
        doc, times = row["doc"][entry].astype(np.int64) - row["n_main"], row["times"][entry].astype(np.int64)
        value = share_others[pair]
        wanted, known = w2[pair] != 0, np.isfinite(value)
        shorter = wanted & ~known & (w1[pair] != 0)                          # one word of context less
        score = np.where(known, value, np.where(shorter, np.log(BACKOFF), 0.0))
        sums.add(block, True, np.bincount(doc, score * times, minlength=n_docs))
        missing = wanted & ~known
        if order == 2:
            parts = [(missing, w2[pair])]
        else:
            mid, also = np.zeros(len(refs), np.uint64), np.zeros(len(refs), np.uint64)
            of_pairs = np.unique(pair)
            mid[of_pairs] = row["mid"]
            also[of_pairs[w2[of_pairs] == OPEN]] = row["also"]
            opens = missing & (w2[pair] == OPEN)                             # the others lack the first two words together
            parts = [(opens, mid[pair]), (opens, also[pair]), (missing & (w1[pair] == 0), w2[pair])]
            on = np.flatnonzero(shorter & ~opens)
            if len(on):
                mid, last = mid[pair][on], w2[pair][on]
                needs.add(SHORTER, True, block, doc[on], times[on], _contexts(mid, last), mid, last)
        for which, w in parts:
            if which.any():
                needs.add(WORDS, True, block, doc[which], times[which], w[which])
    return run


def _context_scores(buckets: int, hot: np.ndarray, hot_others: np.ndarray, others: int):
    """Buckets, sorted, counts of contexts first: n-grams of two words that the others have score ``c(w1 w2) / N`` here and
    ``N / c(w1)`` at the word ``w1``; the rest goes on to its last word."""
    def run(batches):
        sums, needs, now, table, counts = _Sums(), _Needs(buckets), None, [], []
        for batch in batches:
            for at in range(0, batch.num_rows, 16):
                for row in batch.slice(at, 16).to_pylist():
                    if row["bucket"] != now:
                        now, table, counts = row["bucket"], [hot], [hot_others]
                    if row["kind"] == CONTEXTS:
                        table.append(_unfold(row["w"], np.uint64))
                        counts.append(_unfold(row["times"], np.int64))
                    elif row["kind"] == SHORTER:
                        if len(table) > 1 or table[0] is hot:
                            w, place = np.unique(np.concatenate(table), return_index=True)   # of a hot context the first, whole count
                            table, counts = [w], [np.concatenate(counts)[place]]
                        scored(row, table[0], counts[0], sums, needs)
                    elif row["kind"] == TOTALS:
                        sums.add(row["block"], row["held"], _unpack_sums(row["sums"]), row["docs"])
                    else:
                        yield _batch([tuple(row[f.split()[0]] for f in NEEDS.split(", "))], NEEDS)
                    if needs.n > PENDING_NEEDS:
                        yield from needs.take()
                    if sums.bytes > PENDING_BYTES:
                        yield from sums.needs(buckets)
        yield from needs.take()
        yield from sums.needs(buckets)

    def scored(row, table, counts, sums, needs):
        w, blocks = _unfold(row["w"], np.uint64), _unfold(row["blocks"], np.int64)
        doc, times = _unfold(row["doc"], np.uint32), _unfold(row["times"], np.int32)
        place, known = _places(table, w)
        c = np.where(known, counts[place], 0) if len(table) else np.zeros(len(w), np.int64)
        sums.add_single(True, blocks, doc, np.log(np.where(c > 0, c / max(others, 1), BACKOFF)) * times)
        word = np.where(c > 0, _unfold(row["mid"], np.uint64), _unfold(row["last"], np.uint64))
        needs.add(WORDS, True, blocks, doc, np.where(c > 0, -times, times), word)
    return run


def _word_scores(total: int, others: int):
    """Buckets, sorted, word counts first: adds what the backed-off words score; one row of sums per block and task."""
    def run(batches):
        sums, now, known, logs = _Sums(), None, None, {}
        for batch in batches:
            rows = batch.drop_columns(["words", "counts", "others"]).to_pylist()
            for row, words_of, counts, rest in zip(rows, batch.column("words"), batch.column("counts"), batch.column("others")):
                if row["kind"] == 0:
                    w = words_of.values.to_numpy(zero_copy_only=False).view(np.uint64)
                    order = np.argsort(w)
                    now, known = row["bucket"], w[order]
                    t = rest.values.to_numpy(zero_copy_only=False)[order]
                    logs = {False: np.log(counts.values.to_numpy(zero_copy_only=False)[order] / total),
                            True: np.log(np.where(t > 0, t, BACKOFF) / max(others, 1))}
                elif row["kind"] == TOTALS:
                    sums.add(row["block"], row["held"], _unpack_sums(row["sums"]), row["docs"])
                else:
                    if row["bucket"] != now:
                        raise AssertionError("a word without a count")
                    value = logs[row["held"]][np.searchsorted(known, _unfold(row["w"], np.uint64))] * _unfold(row["times"], np.int32)
                    sums.add_single(row["held"], _unfold(row["blocks"], np.int64), _unfold(row["doc"], np.uint32), value)
                if sums.bytes > PENDING_BYTES:
                    yield _batch([(b, h, d, _pack_sums(v)) for b, h, v, d in sums.take()], SUMS)
        yield _batch([(b, h, d, _pack_sums(v)) for b, h, v, d in sums.take()], SUMS)
    return run


SCORED = "doc_id long, n_words long, log_score double, held_out boolean, held_out_log_score double"


def _per_document(batches):
    """Blocks, sorted, to one row per document."""
    now, values, again, docs = None, None, None, b""

    def rows():
        n = len(docs) // 17                                  # what comes after the lengths is shorter
        ids, known, lengths = np.frombuffer(docs[:8 * n], np.int64), docs[8 * n:9 * n], np.frombuffer(docs[9 * n:17 * n], np.int64)
        n_main = int(np.frombuffer(docs[17 * n:], np.int64)[0])
        more = [None] * n_main + _plus(again, np.zeros(n - n_main)).tolist()
        return _batch([(i if k else None, w, v, m is not None, m)
                       for i, k, w, v, m in zip(ids.tolist(), known, lengths.tolist(), _plus(values, np.zeros(n)).tolist(), more)], SCORED)
    for batch in batches:
        for row in batch.to_pylist():
            if row["block"] != now:
                if now is not None:
                    yield rows()
                now, values, again, docs = row["block"], None, None, b""
            found = _unpack_sums(row["sums"])
            if row["held"]:
                again = _plus(again, found)
            else:
                values = _plus(values, found)
            docs = row["docs"] or docs
    if now is not None:
        yield rows()


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int = BUCKET_BYTES,
          order: int = 2, least: int | None = None, held_out: Column | None = None) -> DataFrame:
    """``doc_id, n_words, log_score, mean_log_score`` for every row.

    With ``held_out`` (a condition; null: no) also ``held_out`` and ``held_out_log_score``, the score of the rows that are
    held out by the counts of all rows that are not; null for the others.

    ``order`` is 2 or 3; ``least`` is ``LEAST`` at order 2 and 1 (all counts) at order 3, where it can be nothing else.
    Null, empty and blank texts have no words: score 0 and a null mean.
    Repeated rows count, and are scored, as often as they come; a null doc_id
    stays null; an empty table gives no rows.  Words are known by a 48-bit
    hash (of V distinct words about V * V / 2**49 pairs share one).  The driver sees the totals and the at most ``HOT`` hot words and contexts.
    """
    least = least if least is not None else LEAST if order == 2 else 1
    if order not in (2, 3) or least < 1 or order == 3 and least > 1:
        raise ValueError("order 2 with any least of 1 or more, or order 3 with least 1")
    out = F.lit(False) if held_out is None else F.coalesce(held_out, F.lit(False))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), out.alias("held"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(8, -(-size * (order - 1) // bucket_bytes))     # pairs of order 3 repeat less, so tables are larger
    counts = checkpointed(word_counts(rows))
    total, others = (x or 0 for x in counts.agg(F.sum("c"), F.sum("t")).first())

    def most(table: DataFrame) -> list[np.ndarray]:
        found = sorted((r["w"] & (1 << 64) - 1, r["c"], r["t"]) for r in table.where(F.col("c") * HOT >= total).collect())
        return [np.array([f[k] for f in found], kind) for k, kind in enumerate((np.uint64, np.int64, np.int64))]
    hot, hot_counts, hot_others = most(counts)
    if order == 3 and len(hot):                                 # a context is not more frequent than its words
        hot, hot_counts, hot_others = most(context_counts(rows, hot))

    blocks = pair_blocks(rows, hot, buckets, order).repartition(buckets, "bucket").sortWithinPartitions("bucket")
    needs = blocks.mapInArrow(_pair_scores(buckets, hot, hot_counts, hot_others, least, total, others, order), NEEDS)
    if order == 3 and held_out is not None:
        needs = needs.repartition(buckets, "bucket").sortWithinPartitions("bucket", "kind").mapInArrow(
            _context_scores(buckets, hot, hot_others, others), NEEDS)
    of_bucket = (F.shiftrightunsigned("w", 17) % buckets).cast("int")
    words_of = counts.groupBy(of_bucket.alias("bucket")).agg(F.collect_list("w").alias("words"), F.collect_list("c").alias("counts"),
                                                             F.collect_list("t").alias("others"))
    both = needs.unionByName(words_of.withColumn("kind", F.lit(0)), allowMissingColumns=True)
    dealt = both.repartition(buckets, "bucket").sortWithinPartitions("bucket", "kind")
    sums = dealt.mapInArrow(_word_scores(total, others), SUMS)
    scored = sums.repartition("block").sortWithinPartitions("block").mapInArrow(_per_document, SCORED)
    columns = ["doc_id", "n_words", F.round("log_score", 6).alias("log_score"),
               F.when(F.col("n_words") > 0, F.round(F.col("log_score") / F.col("n_words"), 6)).alias("mean_log_score")]
    if held_out is not None:
        columns += ["held_out", F.round("held_out_log_score", 6).alias("held_out_log_score")]
    return scored.select(*columns)
