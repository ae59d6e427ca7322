"""Repeated passages by a compacted de Bruijn graph of words.

A window of ``K`` consecutive words is an edge from the hash of its first
``K - 1`` words to the hash of its last ``K - 1``.  Only edges that more than
one document has make up the graph.  An edge's source is its place in the
first document (smallest doc_id) that has it.  Edges that follow each other in
their source, through a node with one edge in and one out, are one path: the
nodes' degrees are counted, and joined with the edges that begin there.  What
a document copies is cut along the paths, and each piece is compared, by a
SHA-256 of the words in both places, with the source before it counts.

Windows travel to their partition in runs: consecutive windows that have the
same smallest hash of ``ANCHOR`` words share a row, and equal windows always
have the same one.  The windows of anchors that very many documents have are
dealt to several places (a sample of documents tells which; it decides nothing
else).
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import join_small, stored

K = 13                  # words of a window
ANCHOR = 4              # words of an anchor
RUN = 64                # windows of a row at most
SLICE = 1 << 20         # bytes of a text that are cut into words at a time
HOT_SAMPLE = 64         # one document of so many is looked at for hot anchors
HOT_SHARE = 0.02        # of the sampled documents (10 at least): the windows of an anchor of more are dealt to ``SALTS`` places
SALTS = 32
NODE = 5                # bytes of a node's hash
BIN = 4096              # words of a bin in which copies meet paths

_ROWS = "salt int, t long, nodes binary, doc_id long, pos long, h long"
_EDGE_KEY, _PLACE = ["h", "salt", "src", "dst"], ["doc_id", "t", "pos"]
_SOURCE = ["from_doc", "from_t", "from_pos"]
_GAP = re.compile(rb"[\x20\x09-\x0D]")


def _odd(seed: int, n: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


_NODE_FACTORS, _ANCHOR_FACTORS = _odd(1, 1 << 10), _odd(2, 1 << 10)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def _slices(text: str | None):
    """The words of a text, some at a time; bytes.split() cuts at exactly the white space of the contract."""
    raw, at = (text or "").encode(), 0
    while at < len(raw):
        gap = _GAP.search(raw, at + SLICE)
        end = gap.start() if gap else len(raw)
        yield raw[at:end].split()
        at = end


class _Words:
    """The words of a text, joined by single blanks, and where they begin."""

    def __init__(self, text: str | None):
        self.raw = b" ".join(b" ".join(words) for words in _slices(text) if words)
        gaps = np.flatnonzero(np.frombuffer(self.raw, np.uint8) == 32)
        self.starts = np.concatenate([[0], gaps + 1, [len(self.raw) + 1]]) if self.raw else np.zeros(1, np.int64)

    def __len__(self) -> int:
        return len(self.starts) - 1

    def part(self, start: int, end: int) -> bytes:
        return self.raw[self.starts[start]:self.starts[end] - 1] if end > start else b""


def _runs(text: str | None, k: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Hashes of all ``k - 1``-word nodes, the first window of each run, and the runs' anchor hashes."""
    hashed = [np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)) for words in _slices(text)]
    w = np.concatenate(hashed) if hashed else np.zeros(0, np.uint64)
    n = len(w) - k + 1
    if n < 1:
        return None
    nodes, anchors = np.zeros(n + 1, np.uint64), np.zeros(len(w) - anchor + 1, np.uint64)
    for i, f in enumerate(_NODE_FACTORS[:k - 1]):
        nodes += w[i:i + n + 1] * f
    for i, f in enumerate(_ANCHOR_FACTORS[:anchor]):
        anchors += w[i:i + len(anchors)] * f
    anchors = _mix(anchors)
    least = anchors[:n].copy()
    for i in range(1, k - anchor + 1):
        np.minimum(least, anchors[i:i + n], out=least)
    new = np.empty(n, bool)
    new[0], new[1:] = True, least[1:] != least[:-1]
    starts = np.flatnonzero(new)
    size = np.diff(np.append(starts, n))
    if size.max() > RUN:
        starts = np.concatenate([np.arange(s, s + z, RUN) for s, z in zip(starts, size)])
    return _mix(nodes), starts, least[starts]


def _edge_rows(docs: DataFrame, k: int, anchor: int, hot: np.ndarray) -> DataFrame:
    """Runs of windows by anchor: the nodes, the place, and a salt from 1 for the ``hot`` anchors (0 for the others)."""
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                out = []
                for doc_id, t, text in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns)):
                    found = _runs(text, k, anchor)
                    if found is None:
                        continue
                    nodes, starts, h = found
                    h = h.view(np.int64)
                    size = np.append(starts[1:], len(nodes) - 1) - starts + 1       # nodes: one more than windows
                    first = np.cumsum(size) - size
                    which = np.repeat(starts - first, size) + np.arange(size.sum())
                    salt = np.isin(h, hot) * np.int32(1 + doc_id % SALTS) if len(hot) else np.zeros(len(h), np.int32)
                    out.append((salt.astype(np.int32), np.full(len(h), t), size, nodes[which], np.full(len(h), doc_id), starts, h))
                if not out:
                    continue
                salt, t, size, nodes, doc_id, pos, h = (np.concatenate(c) for c in zip(*out))
                ends = pa.py_buffer(np.append(0, np.cumsum(size * NODE)).astype(np.int32))
                raw = pa.py_buffer(np.ascontiguousarray(nodes.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :NODE]))
                packed = pa.Array.from_buffers(pa.binary(), len(size), [None, ends, raw])
                yield pa.RecordBatch.from_arrays([pa.array(salt), pa.array(t), packed, pa.array(doc_id), pa.array(pos), pa.array(h)],
                                                 names=["salt", "t", "nodes", "doc_id", "pos", "h"])
    return docs.select("doc_id", "t", "text").mapInArrow(run, _ROWS)


def _hot_anchors(docs: DataFrame, k: int, anchor: int) -> np.ndarray:
    """Anchors of more than ``HOT_SHARE`` of the sampled documents: a bounded number, whatever the size of the corpus."""
    def run(batches):
        for batch in batches:
            found = [_runs(text, k, anchor) for text in batch.column(0).to_pylist()]
            for f in found:
                if f is not None:
                    yield pa.RecordBatch.from_arrays([pa.array(np.unique(f[2]).view(np.int64))], names=["h"])
    some = docs.where(F.pmod(F.xxhash64("doc_id", "t"), F.lit(HOT_SAMPLE)) == 0)
    least = max(10, int(some.count() * HOT_SHARE))
    counts = some.select("text").mapInArrow(run, "h long").groupBy("h").count().where(F.col("count") > least)
    return np.array([r["h"] for r in counts.select("h").collect()], dtype=np.int64)


def _windows(rows: DataFrame) -> DataFrame:
    """One row per window: its two nodes, its place, and the place of its run."""
    n = F.size("node") - 1
    rows = rows.select("h", "salt", "doc_id", "t", F.col("pos").alias("run"), "node")
    rows = rows.select("h", "salt", "doc_id", "t", "run", F.posexplode(F.arrays_zip(
        F.slice("node", F.lit(1), n).alias("src"), F.slice("node", F.lit(2), n).alias("dst"))).alias("k", "e"))
    return rows.select("h", "salt", "doc_id", "t", "run", (F.col("run") + F.col("k")).alias("pos"), "e.src", "e.dst")


def _fragments(windows: DataFrame) -> DataFrame:
    """Windows of a run that follow each other, here and in their source, as one of the run's ``parts``.

    ``nodes`` (one more than windows) is kept where a part is its own source,
    and where no source is known yet.
    """
    own = F.col("from_doc").isNull() | ((F.col("doc_id") == F.col("from_doc")) & (F.col("t") == F.col("from_t"))
                                        & (F.col("pos") == F.col("from_pos")))
    one = F.struct("pos", F.when(own, F.col("src")).alias("src"), F.when(own, F.col("dst")).alias("dst"))
    group = ["h", "salt", "doc_id", "t", "run", "from_doc", "from_t", "ahead"]
    packed = windows.withColumn("ahead", F.col("from_pos") - F.col("pos")).groupBy(*group).agg(
        F.sort_array(F.collect_list(one)).alias("w"))
    n, first, last = F.size("w"), F.col("w")[0], F.element_at("w", -1)

    def part(at, n, nodes):
        return F.struct((at["pos"] - F.col("run")).alias("k"), n.cast("long").alias("n"), "from_doc", "from_t",
                        (at["pos"] + F.col("ahead")).alias("from_pos"), F.when(at["src"].isNotNull(), nodes).alias("nodes"))
    whole = F.array(part(first, n, F.concat(F.transform("w", lambda x: x["src"]), F.array(last["dst"]))))
    each = F.transform("w", lambda x: part(x, F.lit(1), F.array(x["src"], x["dst"])))
    return packed.select("h", "salt", "doc_id", "t", "run", F.when(last["pos"] - first["pos"] + 1 == n, whole).otherwise(each).alias("parts"))


def _shared(docs: DataFrame, k: int, anchor: int) -> DataFrame:
    """Fragments of the windows of more than one document, with their sources; stored.

    All windows of an anchor meet in one partition, those of a hot one in
    ``SALTS``; of the latter, see ``_hot_fragments``.
    """
    of_anchor, of_edge = Window.partitionBy("h", "salt"), Window.partitionBy(*_EDGE_KEY)
    runs = _edge_rows(docs, k, anchor, _hot_anchors(docs, k, anchor))
    runs = (runs.withColumn("least", F.min("doc_id").over(of_anchor)).withColumn("most", F.max("doc_id").over(of_anchor))
            .where("salt > 0 or least < most").drop("least", "most"))
    runs = runs.distinct()                      # repeated rows name the same places; the anchor has dealt them out already
    node = F.expr(f"transform(sequence(0, octet_length(nodes) div {NODE} - 1), "
                  f"i -> cast(conv(hex(substring(nodes, i * {NODE} + 1, {NODE})), 16, 10) as bigint))")
    windows = _windows(runs.withColumn("node", node))
    windows = (windows.withColumn("from", F.min(F.struct(*_PLACE)).over(of_edge)).withColumn("most", F.max("doc_id").over(of_edge))
               .where("salt > 0 or from.doc_id < most"))
    cold = F.col("salt") == 0
    windows = windows.select(*_EDGE_KEY, "run", *_PLACE, *[F.when(cold, F.col(f"from.{p}")).alias(c) for p, c in zip(_PLACE, _SOURCE)])
    found = stored(_fragments(windows), "fragments")

    columns = ["doc_id", "t", "run", "parts"]
    found = found.where("salt = 0").select(*columns).unionByName(_hot_fragments(found.where("salt > 0")).select(*columns))
    found = found.select("doc_id", "t", "run", F.explode("parts").alias("p"))
    pos = F.col("run") + F.col("p.k")
    own = (F.col("doc_id") == F.col("p.from_doc")) & (F.col("t") == F.col("p.from_t")) & (pos == F.col("p.from_pos"))
    return found.select("doc_id", "t", pos.alias("pos"), "p.n", *[f"p.{c}" for c in _SOURCE], F.when(own, F.col("p.nodes")).alias("nodes"))


def _hot_fragments(runs: DataFrame) -> DataFrame:
    """The parts of the runs of hot anchors; stored.  Equal runs are looked at once, at their first place, and joined back."""
    runs = runs.select("h", "doc_id", "t", (F.col("run") + F.col("parts")[0]["k"]).alias("run"), F.col("parts")[0]["nodes"].alias("node"))
    place = ["doc_id", "t", "run"]
    contents = runs.groupBy("h", "node").agg(F.min(F.struct(*place)).alias("at"), F.max("doc_id").alias("most"))
    contents = stored(contents.select("h", "node", "at.*", "most", F.lit(0).alias("salt")), "hot-runs")
    windows = _windows(contents.withColumnRenamed("run", "pos"))
    firsts = windows.join(contents.select("h", *place, "most"), ["h", *place]).groupBy(*_EDGE_KEY).agg(
        F.min(F.struct(*_PLACE)).alias("from"), F.max("most").alias("most"))
    firsts = stored(firsts.where("from.doc_id < most").drop("most"), "hot-edges")
    known = windows.join(firsts, _EDGE_KEY).select(
        *_EDGE_KEY, "run", *_PLACE, *[F.col(f"from.{p}").alias(c) for p, c in zip(_PLACE, _SOURCE)])
    parts = _fragments(known).groupBy("h", *place).agg(F.flatten(F.collect_list("parts")).alias("parts"))
    parts = stored(contents.select("h", "node", *place).join(parts, ["h", *place]).select("h", "node", "parts"), "hot-parts")
    return stored(runs.join(parts, ["h", "node"]).select(*place, "parts"), "hot-fragments")


def _joined_up(parts: DataFrame, group: list[str]) -> DataFrame:
    """Parts ``[pos, pos + n)`` of a group that touch, as one."""
    along = Window.partitionBy(*group).orderBy("pos")
    new = F.coalesce((F.lag(F.col("pos") + F.col("n")).over(along) != F.col("pos")).cast("int"), F.lit(1))
    parts = parts.withColumn("new", new).withColumn("part", F.sum("new").over(along))
    return parts.groupBy(*group, "part").agg(F.min("pos").alias("pos"), F.sum("n").alias("n")).drop("part")


def _paths(fragments: DataFrame) -> DataFrame:
    """Paths of the graph: ``from_doc, from_t, start`` of the first window and ``length`` in windows.

    The windows of a source that follow each other share their nodes; they are
    cut at the nodes that have not exactly one edge in and one out.
    """
    edges = fragments.where("nodes is not null").select("doc_id", "t", "pos", "n", "nodes")
    ends = edges.select("n", F.posexplode("nodes").alias("k", "node"))
    nodes = ends.groupBy("node").agg(F.count_if(F.col("k") > 0).alias("n_in"), F.count_if(F.col("k") < F.col("n")).alias("n_out"))
    branching = stored(nodes.where("n_in <> 1 or n_out <> 1").select("node"), "branching")
    begin = edges.select("doc_id", "t", "pos", F.posexplode(F.slice("nodes", F.lit(1), F.col("n").cast("int"))).alias("k", "node"))
    cuts = join_small(begin, branching, ["node"], "inner").select("doc_id", "t", (F.col("pos") + F.col("k")).alias("pos"))
    runs = _joined_up(edges.drop("nodes"), ["doc_id", "t"])
    points = runs.select("doc_id", "t", "pos", (F.col("pos") + F.col("n")).alias("end")).unionByName(
        cuts.withColumn("end", F.lit(None).cast("long")))
    points = points.groupBy("doc_id", "t", "pos").agg(F.max("end").alias("end"))
    along = Window.partitionBy("doc_id", "t").orderBy("pos")
    end = F.last("end", ignorenulls=True).over(along)
    points = points.withColumn("stop", F.least(end, F.lead("pos").over(along)))
    return points.select(F.col("doc_id").alias("from_doc"), F.col("t").alias("from_t"), F.col("pos").alias("start"),
                         (F.col("stop") - F.col("pos")).alias("length"))


def _copies(fragments: DataFrame) -> DataFrame:
    """Windows of a document that are one stretch of a smaller doc_id's: place, source place and ``n`` windows."""
    taken = fragments.where("from_doc < doc_id").drop("nodes").withColumn("ahead", F.col("from_pos") - F.col("pos"))
    taken = _joined_up(taken, ["doc_id", "t", "from_doc", "from_t", "ahead"])
    return taken.select(*_PLACE, "from_doc", "from_t", (F.col("pos") + F.col("ahead")).alias("from_pos"), "n")


def _pieces(copies: DataFrame, paths: DataFrame) -> DataFrame:
    """The copies, cut where a path of their source begins or ends; pairs meet in bins of ``BIN`` words, once."""
    bins = lambda at, n: F.explode(F.sequence(F.floor(at / BIN), F.floor((at + n - 1) / BIN)))
    left = copies.withColumn("bin", bins(F.col("from_pos"), F.col("n")))
    right = paths.withColumn("bin", bins(F.col("start"), F.col("length")))
    low = F.greatest("from_pos", "start")
    high = F.least(F.col("from_pos") + F.col("n"), F.col("start") + F.col("length"))
    met = left.join(right, ["from_doc", "from_t", "bin"]).where((low < high) & (F.floor(low / BIN) == F.col("bin")))
    return met.select("doc_id", "t", (F.col("pos") + low - F.col("from_pos")).alias("pos"), "from_doc", "from_t",
                      low.alias("from_pos"), (high - low).alias("n"))


def _digests(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """SHA-256 of the words ``[pos, pos + n)`` of each document in ``wanted``."""
    lists = wanted.groupBy("doc_id", "t").agg(F.collect_list(F.struct("pos", "n")).alias("parts"))
    lists = stored(lists, "places")

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                words = _Words(row["text"])
                found = [(row["doc_id"], row["t"], p["pos"], p["n"], hashlib.sha256(words.part(p["pos"], p["pos"] + p["n"])).digest())
                         for p in row["parts"]]
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), kinds)],
                                                 names=["doc_id", "t", "pos", "n", "digest"])
    rows = docs.select("doc_id", "t", "text").join(lists, ["doc_id", "t"])
    return rows.mapInArrow(run, "doc_id long, t long, pos long, n long, digest binary")


def _verified(docs: DataFrame, pieces: DataFrame, k: int) -> DataFrame:
    """The pieces whose words are those of their source; stored."""
    pieces = stored(pieces.withColumn("n_words", F.col("n") + (k - 1)), "pieces")
    here = pieces.select(*_PLACE, F.col("n_words").alias("n"))
    there = pieces.select(F.col("from_doc").alias("doc_id"), F.col("from_t").alias("t"), F.col("from_pos").alias("pos"),
                          F.col("n_words").alias("n"))
    digests = stored(_digests(docs, here.union(there).distinct()), "digests")
    mine = digests.select(*_PLACE, F.col("n").alias("n_words"), "digest")
    theirs = digests.select(F.col("doc_id").alias("from_doc"), F.col("t").alias("from_t"), F.col("pos").alias("from_pos"),
                            F.col("n").alias("n_words"), F.col("digest").alias("from_digest"))
    both = pieces.join(mine, [*_PLACE, "n_words"]).join(theirs, ["from_doc", "from_t", "from_pos", "n_words"])
    return stored(both.where("digest = from_digest").drop("digest", "from_digest"), "verified")


def _marked(docs: DataFrame) -> DataFrame:
    """``doc_id, t, text, copy``: whether a smaller doc_id has the same text, and a number for texts that share a doc_id.

    A text with copies is looked at once, in its smallest doc_id; ``t`` is 0
    where the doc_id has no other text, and then the doc_id alone is the row's
    name.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("md5", F.md5("text"))
    names = rows.where("doc_id is not null and text is not null").select("doc_id", "md5").distinct()
    names = stored(names, "names")
    home = stored(names.groupBy("md5").agg(F.min("doc_id").alias("home"), F.count("*").alias("n")).where("n > 1").drop("n"), "homes")
    at_home = names.join(home, "md5", "left").withColumn("copy", F.coalesce(F.col("doc_id") > F.col("home"), F.lit(False)))
    crowded = names.groupBy("doc_id").agg(F.min("md5").alias("a"), F.max("md5").alias("b")).where("a < b").select("doc_id")
    notes = at_home.join(crowded.withColumn("crowded", F.lit(True)), "doc_id", "left")
    notes = notes.where("copy or crowded").select(
        "doc_id", "md5", "copy", F.when(F.col("crowded"), F.conv(F.substring("md5", 1, 15), 16, 10).cast("long"))
        .otherwise(F.lit(0)).alias("t"))
    marked = join_small(rows, stored(notes, "notes"), ["doc_id", "md5"], "left")
    return marked.select("doc_id", F.coalesce("t", F.lit(0)).alias("t"), "text", F.coalesce("copy", F.lit(False)).alias("copy"))


def copied_passages(docs: DataFrame, k: int = K, anchor: int = ANCHOR) -> tuple[DataFrame, DataFrame]:
    """The marked rows, and the verified pieces that distinct texts copy from smaller doc_ids.

    A piece is ``doc_id, t, pos, n_words`` with its source ``from_doc, from_t,
    from_pos`` (word places from 0).
    """
    rows = _marked(docs)
    texts = rows.where("not copy and doc_id is not null and text is not null")
    fragments = _shared(texts, k, anchor)
    return rows, _verified(texts, _pieces(_copies(fragments), _paths(fragments)), k)


def drop_copied(docs: DataFrame, k: int = K, anchor: int = ANCHOR, keep_text: bool = False) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every row, without the passages that a smaller doc_id has.

    Words are runs of ``[^\\x20\\x09-\\x0D]``; removed is each word that a
    window of ``k`` words covers whose words also stand, in turn, in a row with
    a smaller doc_id.  ``kept_sha256`` hashes the other words, joined by a
    blank; ``keep_text`` adds them as ``kept``.  Null and empty texts have no
    words; texts of fewer than ``k`` words lose none.  Rows of one doc_id take
    nothing from each other; a row without doc_id neither gives nor loses;
    repeated rows have equal results; an empty table gives no rows; other
    columns are ignored.  Should two different windows have the same hashes
    (144 bits), the comparison with the source keeps the words.
    """
    rows, pieces = copied_passages(docs, k, anchor)
    spans = stored(pieces.groupBy("doc_id", "t").agg(F.sort_array(F.collect_list(F.struct("pos", "n_words"))).alias("spans")), "spans")
    rows = rows.join(spans, ["doc_id", "t"], "left").select("doc_id", "text", "copy", "spans")

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                out = []
                for row in batch.slice(at, 64).to_pylist():
                    words = _Words(row["text"])
                    spans = [(0, len(words))] if row["copy"] and len(words) >= k else [
                        (s["pos"], s["pos"] + s["n_words"]) for s in row["spans"] or ()]
                    kept, done, removed = [], 0, 0
                    for start, end in spans:
                        if start > done:
                            kept.append(words.part(done, start))
                        removed += max(0, end - max(start, done))
                        done = max(done, end)
                    if done < len(words):
                        kept.append(words.part(done, len(words)))
                    left = b" ".join(kept)
                    out.append((row["doc_id"], len(words), removed, hashlib.sha256(left).hexdigest(),
                                *([left.decode()] if keep_text else [])))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)
    names = ["doc_id", "n_words", "n_removed", "kept_sha256", *(["kept"] if keep_text else [])]
    return rows.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * keep_text)
