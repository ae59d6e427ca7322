"""SimHash near-duplicates by tiled exact comparison.

Fingerprints are compared exactly: distinct fingerprints are laid out in tiles
of equal population count, two tiles are compared with numpy exclusive-or and
bit counts, and tile pairs whose population counts differ by more than the
radius are never formed (a bit flip changes the count by one).  Inside a pair
the rows are laid out once more by the population count of their low half, and
blocks whose halves together differ beyond the radius are skipped as well.

A pair of tiles returns a spanning forest of its links, not the links: the
components stay exactly the same and a group of n close fingerprints gives at
most n - 1 rows per tile pair instead of n * n.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import checkpointed, free_name
from tessera.llm.graph import components

SEED = 42                   # seed of XXH64
SHINGLE = 3                 # words of a shingle
RADIUS = 3                  # largest number of differing bits of a link
TILE = 1 << 16              # expected fingerprints of a tile (512 KB)
PIECE = 4 << 20             # bytes of a text that are split into words at a time
CELLS = 1 << 22             # comparisons of one numpy step
_SPACE = b" \t\n\r\x0b\x0c"


def _word_pieces(data: bytes) -> Iterator[list[bytes]]:
    """The words of a text, a bounded part of it at a time (cut at white space)."""
    if len(data) <= PIECE:
        yield data.split()
        return
    at = 0
    while at < len(data):
        end = min(at + PIECE, len(data))
        while end < len(data) and data[end] not in _SPACE:
            end += 1
        yield data[at:end].split()
        at = end


def fingerprint(data: bytes | None, shingle: int = SHINGLE) -> int:
    """Fingerprint of UTF-8 text: bit set if it is set in over half the shingle hashes."""
    if not data:
        return 0
    ones, n, carry = np.zeros(64, np.int64), 0, []
    for words in _word_pieces(data.lower()):   # bytes.lower and bytes.split know ASCII only, as asked for
        words = carry + words
        if len(words) >= shingle:
            line = b" ".join(words)
            ends = np.cumsum([len(w) + 1 for w in words]) - 1
            starts = [0, *(ends[:-1] + 1).tolist()]
            hashes = [xxhash.xxh64_intdigest(line[a:b], SEED) for a, b in zip(starts, ends[shingle - 1:].tolist())]
            for i in range(0, len(hashes), 8192):
                part = np.array(hashes[i:i + 8192], dtype="<u8").view(np.uint8).reshape(-1, 8)
                ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            n += len(hashes)
        carry = words[-(shingle - 1):] if shingle > 1 else []
    if not n:
        if not carry:
            return 0
        return xxhash.xxh64_intdigest(b" ".join(carry), SEED)   # fewer words than a shingle: the whole sequence
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                 more: Sequence[Column] = ()) -> DataFrame:
    """``(doc_id, fp)`` and the string columns ``more`` for every row; ``fp`` is the fingerprint as a signed long."""
    def run(batches):
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            fps = np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps), *batch.columns[2:]], names=names)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *more)
    names = ["doc_id", "fp", *rows.columns[2:]]
    return rows.mapInArrow(run, ", ".join(["doc_id long, fp long", *(f"{c} string" for c in names[2:])]))


def _find(parent: list[int], x: int) -> int:
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def tile_forest(left: np.ndarray, right: np.ndarray | None, radius: int) -> list[tuple[int, int]]:
    """Links ``(i, j)`` that connect what the fingerprints of a tile pair connect.

    ``j`` counts on after the rows of ``left``; ``right`` None compares a tile with itself.
    """
    both = left if right is None else np.concatenate([left, right])
    n, shift = len(both), 0 if right is None else len(left)
    parent, label, links = list(range(n)), np.arange(n), []
    low, high = (np.bitwise_count(both & np.uint64(0xFFFFFFFF)).astype(int), np.bitwise_count(both >> np.uint64(32)).astype(int))
    cell = low * 64 + high

    def blocks(lo, hi):
        rows = np.arange(lo, hi)[np.argsort(cell[lo:hi], kind="stable")]
        cuts = np.flatnonzero(np.diff(cell[rows])) + 1
        return [(low[r[0]], high[r[0]], r) for r in np.split(rows, cuts) if len(r)]
    first, second = blocks(0, shift or n), blocks(shift, n)
    for la, ha, rows_a in first:
        for lb, hb, rows_b in second:
            if abs(la - lb) + abs(ha - hb) > radius or right is None and (lb, hb) < (la, ha):
                continue
            values_b, step = both[rows_b], max(1, CELLS // max(1, len(rows_b)))
            for at in range(0, len(rows_a), step):
                part = rows_a[at:at + step]
                near = np.bitwise_count(both[part][:, None] ^ values_b[None, :]) <= radius
                i, j = np.nonzero(near)
                i, j = part[i], rows_b[j]
                apart = label[i] != label[j]
                if not apart.any():
                    continue
                i, j = i[apart], j[apart]
                _, one = np.unique(label[i] * n + label[j], return_index=True)   # one link of each pair of groups
                moved = []
                for x, y in zip(i[one].tolist(), j[one].tolist()):
                    p, q = _find(parent, x), _find(parent, y)
                    if p != q:
                        parent[max(p, q)] = min(p, q)
                        moved.append(max(p, q))
                        links.append((x, y))
                to = np.arange(n)
                to[moved] = [_find(parent, x) for x in moved]
                label = to[label]
    return links


def links(distinct: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """``(a, b)``: a spanning forest, per tile pair, of the links between distinct fingerprints ``fp``.

    Only the 65 counts of fingerprints per population count reach the driver.
    """
    by_count = distinct.select("fp", F.bit_count("fp").alias("pc"))
    sizes = {r["pc"]: r["count"] for r in by_count.groupBy("pc").count().collect()}
    splits = F.array(*[F.lit(-(-sizes.get(p, 0) // tile)) for p in range(65)])
    tiles = (by_count.withColumn("sub", F.pmod(F.xxhash64("fp"), splits[F.col("pc")]).cast("int"))
             .groupBy("pc", "sub").agg(F.collect_list("fp").alias("fps")))
    tiles = checkpointed(tiles)

    def copies(side: str, other: str, low, high):
        t = tiles.select(F.col("pc").alias(f"pc_{side}"), F.col("sub").alias(f"sub_{side}"), F.col("fps").alias(f"fps_{side}"))
        t = t.withColumn(f"pc_{other}", F.explode(F.sequence(low(F.col(f"pc_{side}")), high(F.col(f"pc_{side}")))))
        t = t.where(splits[F.col(f"pc_{other}")] > 0)
        return t.withColumn(f"sub_{other}", F.explode(F.sequence(F.lit(0), splits[F.col(f"pc_{other}")] - 1)))
    one = copies("a", "b", lambda c: c, lambda c: F.least(c + radius, F.lit(64)))
    two = copies("b", "a", lambda c: F.greatest(c - radius, F.lit(0)), lambda c: c)
    keys = ["pc_a", "sub_a", "pc_b", "sub_b"]
    pairs = (one.where("pc_a < pc_b or sub_a <= sub_b").join(two.where("pc_a < pc_b or sub_a <= sub_b"), keys)
             .select((F.struct("pc_a", "sub_a") == F.struct("pc_b", "sub_b")).alias("same"), "fps_a", "fps_b"))

    def run(batches):
        for batch in batches:
            for same, a, b in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                left = a.values.to_numpy(zero_copy_only=False).view(np.uint64)
                right = None if same else b.values.to_numpy(zero_copy_only=False).view(np.uint64)
                both = left if same else np.concatenate([left, right])
                found = np.array(tile_forest(left, right, radius), dtype=np.int64).reshape(-1, 2)
                ends = both.view(np.int64)[found]
                yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], names=["a", "b"])
    return pairs.mapInArrow(run, "a long, b long")


def _grouped(prints: DataFrame, radius: int, tile: int) -> DataFrame:
    """``(fp, rep, root)``: the smallest doc_id and the group of every distinct fingerprint."""
    distinct = checkpointed(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")))
    roots = components(links(distinct, radius, tile), "a", "b")
    return distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "rep", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` for every row of ``docs``.

    ``component_id`` is the smallest doc_id that links of at most ``radius``
    differing bits reach.  Null, empty and blank texts have fingerprint zero
    and are linked like any other; repeated rows stay repeated; a null doc_id
    never names a component (a component of such rows only has a null id); an
    empty table gives no rows.  Other columns of ``docs`` are not looked at.
    """
    prints = checkpointed(fingerprints(docs, id_col, text_col, shingle))
    grouped = _grouped(prints, radius, tile)
    ids = grouped.groupBy("root").agg(F.min("rep").alias("component_id"))
    of_fp = grouped.join(ids, "root").select("fp", "component_id")
    return prints.join(of_fp, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
             radius: int = RADIUS) -> DataFrame:
    """One row of ``docs`` of each group, all columns: the one with the smallest doc_id, then the smallest hash of its text.

    Rows with a null doc_id come last, so one stays only in a group that has
    no other; of rows that repeat both doc_id and text one stays.
    """
    text, doc_id = F.coalesce(F.col(text_col).cast("string"), F.lit("")), F.col(id_col).cast("long")
    row = F.concat_ws(":", doc_id.cast("string"), F.sha2(text.cast("binary"), 256)).alias("_row")
    prints = checkpointed(fingerprints(docs, id_col, text_col, shingle, [row]))
    first = F.min_by("_row", F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("_row")))
    stay = prints.join(_grouped(prints, radius, TILE).select("fp", "root"), "fp").groupBy("root").agg(first.alias("_stay"))
    name = free_name(docs, "_row")
    kept = docs.withColumn(name, row).join(stay.select(F.col("_stay").alias(name)), name, "left_semi")
    return kept.dropDuplicates([name]).select(*docs.columns)
