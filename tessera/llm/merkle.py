"""Merkle tree of a dataset whose parents keep SHA-256 states, so that a changed row is checked by folding.

Leaves hang in groups of ``FAN`` under their source, the sources' roots in
groups of ``FAN`` under the root.  Every parent keeps a copy of its hash state
before each child slot: to see what a replaced child makes of it, the state of
that slot is resumed with the replacement and the children right of it.  The
left siblings are never hashed again.

Spark builds the tree bottom up, three levels at a time: ``GROUP`` consecutive
nodes are one row, which one task hashes.  Going down again, each group gets
the siblings above it (a few KB) and folds its own nodes.  A source with a
third of all rows is many groups like any other; a step up leaves one node in
4096, so even 10^12 rows take four steps.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, StructField, StructType

from tessera.llm.common import running_total, stored

FAN = 16
DEPTH = 3                       # levels that one task hashes
GROUP = FAN ** DEPTH

_TREE = ["known", "name"]       # a tree's key: whether its source is not null, and the source
_LEVELS = "array<struct<left: binary, right: binary>>"


def record_digest(columns: list[Column]) -> Column:
    """Lowercase hex SHA-256 of the values in turn: null is ``-``, any other its UTF-8 byte count, ``:`` and itself."""
    def part(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return F.sha2(F.concat(*map(part, columns)).cast("binary"), 256)


class _Subtree:
    """Up to ``GROUP`` consecutive nodes and the levels above them, each parent with its states by child slot."""

    def __init__(self, digests: list[bytes], height: int):
        self.levels, self.states = [digests], []
        for _ in range(height):
            below, parents, kept = self.levels[-1], [], []
            for first in range(0, len(below), FAN):
                state, slots = hashlib.sha256(), []
                for child in below[first:first + FAN]:
                    slots.append(state.copy())
                    state.update(child)
                kept.append(slots)
                parents.append(state.hexdigest().encode())
            self.levels.append(parents)
            self.states.append(kept)

    def path(self, at: int) -> list[tuple[bytes, bytes]]:
        """The siblings left and right of node ``at`` and of each of its parents."""
        found = []
        for below in self.levels[:-1]:
            first = at - at % FAN
            found.append((b"".join(below[first:at]), b"".join(below[at + 1:first + FAN])))
            at //= FAN
        return found

    def fold(self, at: int, digest: bytes, path: list[tuple[bytes, bytes]]) -> bytes:
        """The top node if ``digest`` stood in place ``at``."""
        for kept, (_, right) in zip(self.states, path):
            state = kept[at // FAN][at % FAN].copy()
            state.update(digest)
            state.update(right)
            digest, at = state.hexdigest().encode(), at // FAN
        return digest


def _height(n: int) -> int:
    """Levels above ``n`` consecutive nodes until one is left."""
    height = 0
    while n > 1:
        n, height = -(-n // FAN), height + 1
    return height


def _hex(raw) -> bytes:
    return bytes(raw).hex().encode()


def _rows(batch: pa.RecordBatch):
    """The rows of a batch, one group at a time as Python objects."""
    for k in range(batch.num_rows):
        yield batch.slice(k, 1).to_pylist()[0]


def _subtree(row: dict) -> _Subtree:
    return _Subtree([_hex(m["digest"]) for m in row["members"]], min(DEPTH, _height(row["n"])))


def _groups(nodes: DataFrame) -> DataFrame:
    """Rows of ``GROUP`` consecutive nodes of a tree, each with the size of its tree and the digest of its top node.

    ``nodes`` has the tree's key, ``place`` (from 0) and the columns that go along with ``digest``.
    """
    rest = [c for c in nodes.columns if c not in (*_TREE, "place")]
    packed = nodes.groupBy(*_TREE, F.floor(F.col("place") / GROUP).alias("part")).agg(
        F.array_sort(F.collect_list(F.struct("place", *rest))).alias("members"))
    sizes = packed.groupBy(*_TREE).agg(F.sum(F.size("members")).alias("n"))
    packed = packed.join(sizes, _TREE)

    def top(batches):
        for batch in batches:
            tops = [bytes.fromhex(_subtree(row).levels[-1][0].decode())
                    for row in _rows(batch.select(["members", "n"]))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tops, pa.binary())], names=[*batch.schema.names, "top"])
    kind = StructType([*packed.schema, StructField("top", BinaryType())])
    return stored(packed.mapInArrow(top, kind), "merkle")


def _stack(nodes: DataFrame) -> list[DataFrame]:
    """Groups of all steps up, until every tree is one group."""
    steps = [_groups(nodes)]
    while True:
        more = steps[-1].where(F.col("n") > GROUP)
        if more.isEmpty():
            return steps
        steps.append(_groups(more.select(*_TREE, F.col("part").alias("place"), F.col("top").alias("digest"))))


def _down(steps: list[DataFrame], tops: DataFrame, emit, kind: str) -> DataFrame:
    """Goes down from the trees' roots; ``emit`` makes the rows of the lowest groups.

    ``tops`` has, for each tree, the levels above it (``above``) and columns
    that hold for the whole tree.
    """
    extra = [c for c in tops.columns if c not in (*_TREE, "above")]
    given = tops.schema
    keep = ", ".join(f"{c} {given[c].dataType.simpleString()}" for c in (*_TREE, *extra))

    def pass_on(batches):
        for batch in batches:
            for row in _rows(batch):
                tree = _subtree(row)
                yield pa.RecordBatch.from_pylist(
                    [{c: row[c] for c in (*_TREE, *extra)} | {"part": m["place"], "above": _levels(tree.path(k)) + row["above"]}
                     for k, m in enumerate(row["members"])], schema=passed)
    handed = f"{keep}, part long, above {_LEVELS}"
    passed = to_arrow_schema(StructType.fromDDL(handed))
    above = None
    for k in reversed(range(len(steps))):
        rows = steps[k].where(F.col("n") <= GROUP).join(tops, _TREE)
        if above is not None:
            rows = rows.unionByName(steps[k].where(F.col("n") > GROUP).join(above, [*_TREE, "part"]))
        above = rows.mapInArrow(pass_on, handed) if k else rows.mapInArrow(emit, kind)
    return above


def _levels(path: list[tuple[bytes, bytes]]) -> list[dict]:
    raw = lambda digests: bytes.fromhex(digests.decode())
    return [{"left": raw(left), "right": raw(right)} for left, right in path]


def manifest(rows: DataFrame, siblings: bool = False) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root`` for every row of ``rows``.

    ``rows`` has ``doc_id``, ``source``, ``leaf`` and ``changed`` (hex digests;
    ``changed`` is null where nothing changed); other columns are ignored.
    Leaves of a source ascend by doc_id (null first), equal doc_ids by leaf;
    while there are more than one, each run of 16 becomes the SHA-256 of their
    hex digests in turn.  The roots of the sources, null first and then by
    UTF-8 bytes, give the root in the same way; one leaf alone is its source's
    root, one source alone has the root.  ``proof_sha256`` hashes the siblings
    from leaf to root, left to right; ``siblings`` adds them as a column
    ``proof`` (64 hex digits each).  ``folded_root`` is the root with
    ``changed`` in the leaf's place.  Repeated rows are leaves each; a null
    source is a source of its own; an empty table gives no rows.
    """
    raw = rows.select(F.col("source").isNotNull().alias("known"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("name"),
                      F.col("doc_id").cast("long").alias("doc_id"), F.unhex("leaf").alias("digest"),
                      F.unhex("changed").alias("changed"))
    steps = _stack(running_total(raw, ["doc_id", "digest"], F.lit(1), "place", by=_TREE))
    roots = None
    for step in steps:
        done = step.where(F.col("n") <= GROUP).select(*_TREE, F.col("top").alias("digest"))
        roots = done if roots is None else roots.unionByName(done)

    # The tree of the sources' roots: its members carry the key of their source.
    placed = running_total(roots, _TREE, F.lit(1), "place")
    one_tree = [(F.col("place") >= 0).alias("known"), F.substring("name", 1, 0).alias("name")]    # one key, for a join by it
    forest = _stack(placed.select(*one_tree, "place", "digest",
                                  F.col("known").alias("of_known"), F.col("name").alias("of_name")))
    root = forest[-1].where(F.col("n") <= GROUP).select(*_TREE, F.array().cast(_LEVELS).alias("above"), F.col("top").alias("root"))

    def sources(batches):
        for batch in batches:
            for row in _rows(batch):
                tree = _subtree(row)
                found = [(m["of_known"], m["of_name"], _levels(tree.path(k)) + row["above"], m["digest"], row["root"])
                         for k, m in enumerate(row["members"])]
                kinds = (pa.bool_(), pa.string(), pa.list_(pa.struct([("left", pa.binary()), ("right", pa.binary())])),
                         pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), kinds)],
                                                 names=["known", "name", "above", "subroot", "root"])
    tops = _down(forest, root, sources, f"known boolean, name string, above {_LEVELS}, subroot binary, root binary")

    def leaves(batches):
        for batch in batches:
            for row in _rows(batch):
                tree, out = _subtree(row), []
                above = [(_hex(x["left"]), _hex(x["right"])) for x in row["above"]]
                states = [hashlib.sha256(left) for left, _ in above]     # of the parents above, before the slot of this group
                rest = b"".join(left + right for left, right in above)
                subroot, root_hex = bytes(row["subroot"]).hex(), bytes(row["root"]).hex()
                for k, m in enumerate(row["members"]):
                    path = tree.path(k)
                    proof = b"".join(left + right for left, right in path) + rest
                    leaf = tree.levels[0][k]
                    digest = tree.fold(k, leaf if m["changed"] is None else _hex(m["changed"]), path)
                    for state, (_, right) in zip(states, above):
                        state = state.copy()
                        state.update(digest)
                        state.update(right)
                        digest = state.hexdigest().encode()
                    out.append((m["doc_id"], leaf.decode(), subroot, root_hex, hashlib.sha256(proof).hexdigest(),
                                digest.decode(), *([proof.decode()] if siblings else [])))
                kinds = (pa.int64(), *[pa.string()] * (6 if siblings else 5))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", *(["proof"] if siblings else [])]
    return _down(steps, tops, leaves, ", ".join(["doc_id long", *(f"{c} string" for c in names[1:])]))


FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def tamper_check(docs: DataFrame, every: int = 5) -> DataFrame:
    """The manifest of ``docs`` with the text of some rows lower-cased (A-Z only) after it was made, and ``verified``.

    Tampered are the rows where ``every`` divides the CRC-32 of the decimal
    doc_id (a row without doc_id is not); null texts stay null.  ``verified``
    is whether the folded root still is the root: a tampered text without
    capitals, or none, verifies.
    """
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % every == 0
    after = [F.translate(c, upper, upper.lower()) if c == "text" else F.col(c) for c in FIELDS]
    rows = docs.select("doc_id", "source", record_digest([F.col(c) for c in FIELDS]).alias("leaf"),
                       F.when(hit, record_digest(after)).alias("changed"))
    return manifest(rows).withColumn("verified", F.col("folded_root") == F.col("root"))
