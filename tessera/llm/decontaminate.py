"""Benchmark decontamination by pigeonhole edit matching.

A benchmark item occurs in a document if some stretch of the document is at
most ``errors`` edits away from the item, both normalised (lower case, letters
and digits only, single blanks) and with a blank at either end, so that "cat"
is not found in "concatenation".  The number of edits is the same share of
every item's length: items of under 17 characters have to occur unchanged.  An
item cut into ``errors + 1`` pieces has at least one piece that such a stretch
holds unchanged: all pieces are searched at once (Aho-Corasick), and each hit
is verified on the stretch around it with Myers' bit-parallel edit distance.
No occurrence is missed.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import free_name

ERROR_RATE = 0.06           # edits per character of an item
PIECES_AT_ONCE = 100_000    # pieces of one pass over the documents

_GAPS = re.compile(r"[\W_]+")


def normalise(text: str) -> str:
    return _GAPS.sub(" ", text.lower()).strip()


def budget(item: str, rate: float = ERROR_RATE) -> int:
    """Edits that an occurrence of the normalised ``item`` may have."""
    return int(len(item) * rate)


def cut(item: str, errors: int) -> list[tuple[int, str]]:
    """``errors + 1`` pieces of near equal length with their offsets."""
    n, k = len(item), errors + 1
    edges = [i * n // k for i in range(k + 1)]
    return [(a, item[a:b]) for a, b in itertools.pairwise(edges)]


def distance(item: str, stretch: str, masks: dict[str, int] | None = None) -> tuple[int, int]:
    """Least edit distance of ``item`` to any part of ``stretch``, and where the first such part ends (Myers 1999)."""
    best, best_end = len(item), 0
    for at, score in enumerate(_scores(item, stretch, masks if masks is not None else pattern_masks(item), 0), 1):
        if score < best:
            best, best_end = score, at
    return best, best_end


def length_before(item: str, stretch: str, errors: int) -> int:
    """Characters of the shortest end of ``stretch`` that is ``errors`` edits away from ``item``."""
    backwards = item[::-1]
    scores = _scores(backwards, reversed(stretch), pattern_masks(backwards), 1)
    return 0 if errors == len(item) else next(n for n, score in enumerate(scores, 1) if score == errors)


def _scores(item: str, stretch: Iterable[str], masks: dict[str, int], carried: int) -> Iterator[int]:
    """Edit distances of ``item`` to the parts of ``stretch`` that end after each character and begin anywhere
    (``carried`` 0) or at its first one (1)."""
    m = len(item)
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    for c in stretch:
        eq = masks.get(c, 0)
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        ph = minus | ~(xh | plus) & full
        mh = plus & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph, mh = (ph << 1 | carried) & full, (mh << 1) & full
        plus, minus = mh | ~(xv | ph) & full, ph & xv
        yield score


def pattern_masks(item: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


class Matcher:
    """All pieces of a set of normalised items."""

    def __init__(self, items: list[tuple[int, str]], rate: float = ERROR_RATE):
        self.ids = [i for i, _ in items]
        self.items = [f" {t} " for _, t in items]
        self.errors = [budget(t, rate) for _, t in items]
        self.masks = [pattern_masks(t) if e else {} for t, e in zip(self.items, self.errors)]
        places: dict[str, list[tuple[int, int]]] = {}
        for i, t in enumerate(self.items):
            for offset, piece in cut(t, self.errors[i]):
                places.setdefault(piece, []).append((i, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        if places:
            self.automaton.make_automaton()

    def search(self, text: str) -> Iterator[tuple[int, int, int, int]]:
        """``(item id, start, end, distance)``: the best stretch (of the nearest, the first to end) of each item that
        occurs in normalised ``text``."""
        if not self.items:
            return
        given = f" {text} "
        spans: dict[int, list[list[int]]] = {}       # item -> stretches to verify, merged where they overlap
        whole: dict[int, int] = {}                   # item that has to occur unchanged -> end of its first place
        for last, (length, where) in self.automaton.iter(given):
            for i, offset in where:
                if not self.errors[i]:
                    whole.setdefault(i, last + 1)
                    continue
                begin = max(0, last + 1 - length - offset - self.errors[i])
                end = last + 1 - length - offset + len(self.items[i]) + self.errors[i]
                known = spans.setdefault(i, [])
                if known and known[-1][0] <= begin <= known[-1][1]:
                    known[-1][1] = max(known[-1][1], end)
                else:
                    known.append([begin, end])
        found = {i: (0, end) for i, end in whole.items()}
        for i, known in spans.items():
            for begin, end in known:
                errors, stop = distance(self.items[i], given[begin:end], self.masks[i])
                if errors <= self.errors[i]:
                    found[i] = min(found.get(i, (errors, begin + stop)), (errors, begin + stop))
        for i, (errors, end) in found.items():
            item = self.items[i]
            start = end - length_before(item, given[max(0, end - len(item) - errors):end], errors)
            blanks = given[start] == " ", given[end - 1] == " "
            yield self.ids[i], start + blanks[0] - 1, end - blanks[1] - 1, errors


def _passes(benchmark: DataFrame, item_col: str, text_col: str, rate: float, pieces: int) -> Iterator[list[tuple[int, str]]]:
    """The normalised items, as many at a time as have ``pieces`` pieces (one large item may have more)."""
    block, n = [], 0
    rows = benchmark.where(F.col(item_col).isNotNull() & F.col(text_col).isNotNull())
    for row in rows.select(F.col(item_col).cast("long").alias("i"), F.col(text_col).cast("string").alias("t")).toLocalIterator():
        item = normalise(row["t"])
        if not item:
            continue
        if block and n + budget(item, rate) + 1 > pieces:
            yield block
            block, n = [], 0
        block.append((row["i"], item))
        n += budget(item, rate) + 1
    if block:
        yield block


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
            item_text_col: str = "text", rate: float = ERROR_RATE, pieces: int = PIECES_AT_ONCE) -> DataFrame:
    """``doc_id, item_id, start, end, distance`` (offsets in the normalised text): items that occur in documents.

    The shortest of the nearest stretches that end first is given for each
    document and item.

    Items with null id or text, and items without a letter or digit, never
    match; repeated items match once; null and empty documents match nothing.
    The items go to the tasks in blocks of bounded size, one pass over the
    documents for each block.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return _matches(rows, pa.int64(), benchmark, item_col, item_text_col, rate, pieces)


def _matches(rows: DataFrame, id_kind: pa.DataType, benchmark: DataFrame, item_col: str = "item_id", item_text_col: str = "text",
             rate: float = ERROR_RATE, pieces: int = PIECES_AT_ONCE) -> DataFrame:
    """``matches`` of rows ``(doc_id, text)`` whose doc_id is of any kind."""
    spark = rows.sparkSession
    kind = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, item_id long, start int, end int, distance int"
    found = spark.createDataFrame([], kind)
    for block in _passes(benchmark, item_col, item_text_col, rate, pieces):
        shared = spark.sparkContext.broadcast(block)

        def run(batches, shared=shared):
            matcher = Matcher(shared.value, rate)
            for batch in batches:
                out = []
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    if text:
                        out += [(doc_id, *hit) for hit in matcher.search(normalise(text))]
                columns = list(zip(*out)) or [[]] * 5
                kinds = (id_kind, pa.int64(), pa.int32(), pa.int32(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                                 names=["doc_id", "item_id", "start", "end", "distance"])
        found = found.unionByName(rows.mapInArrow(run, kind))
    return found


def _of_texts(docs: DataFrame, benchmark: DataFrame, text_col: str, **options) -> DataFrame:
    """``matches`` with the SHA-256 of the text in place of the id: equal texts have equal matches, whatever their ids."""
    text = F.col(text_col).cast("string")
    return _matches(docs.select(_address(text).alias("doc_id"), text.alias("text")), pa.binary(), benchmark, **options)


def _address(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``doc_id, contaminated, item_ids, n_items, least_distance`` for every row of ``docs``.

    A row is judged by its own text: null and repeated ids do not matter.
    """
    hits = _of_texts(docs, benchmark, text_col, **options).groupBy(F.col("doc_id").alias("_text")).agg(
        F.sort_array(F.collect_set("item_id")).alias("item_ids"), F.min("distance").alias("least_distance"))
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id"), _address(F.col(text_col).cast("string")).alias("_text"))
    none = F.array().cast("array<bigint>")
    return ids.join(hits, "_text", "left").select(
        "doc_id", F.col("item_ids").isNotNull().alias("contaminated"), F.coalesce("item_ids", none).alias("item_ids"),
        F.coalesce(F.size("item_ids"), F.lit(0)).alias("n_items"), "least_distance")


def remove(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` whose text holds no benchmark item; all columns stay.  ``id_col`` is not looked at."""
    name = free_name(docs, "_text")
    hits = _of_texts(docs, benchmark, text_col, **options).select(F.col("doc_id").alias(name)).distinct()
    kept = docs.withColumn(name, _address(F.col(text_col).cast("string"))).join(hits, name, "left_anti")
    return kept.select(*docs.columns)
