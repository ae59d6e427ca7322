"""Approximate nearest neighbours by largest inner product, with multiprobe p-stable hashing.

Vectors are lifted to one sphere (one more component makes all norms equal the
largest norm), where the largest inner product is the smallest Euclidean
distance.  Each of ``TABLES`` tables hashes a vector to ``HASHES`` integers
``floor((a x + b) / w)`` with normal (2-stable) ``a``.  A query looks into its
own bucket and into perturbed ones in the order of their estimated success
(the squared distances to the crossed bucket borders, added up), ``PROBES``
per table.  All candidates of all tables are reranked by the exact inner
product.

Only the bucket width is fitted, on a bounded sample: it is ``WIDTH`` times the
typical distance of the k-th neighbour, near copies left out.  Every row is
indexed.  Queries that found too few are compared with all rows.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import checkpointed

NEIGHBOURS = 20
EVERY = 20                  # queries: rows whose id is divisible by this
TABLES = 8
HASHES = 6
PROBES = 24
WIDTH = 1.9
SAMPLE = 2000               # rows of the sample that the bucket width is fitted on
SAMPLE_QUERIES = 100
SEED = 17
BLOCK = 1024                # rows of a packed block
STEP = 1 << 22              # products of one numpy step
BLOCKS = "bucket long, ids binary, vectors binary"
NEAR = 1e-3                 # of the norm: rows closer than this are near copies
SCAN = 256                  # queries of a block that is compared with all rows
MARGIN = 1e-9               # of the norms' product: more than a matrix product can be off
PENDING = 1 << 20           # candidates that a task holds before it keeps the best only


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, v``: the rows that take part - id not null, vector not null, not zero, every component finite."""
    v = F.col(vector_col)
    finite = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0))


def probe_sets(fraction: np.ndarray, n: int) -> list[list[tuple[int, int]]]:
    """The first ``n`` perturbation sets ((hash, step), ...) in estimated success order, the empty one first.

    ``fraction`` is where in its bucket the query lies; crossing a border costs
    the squared distance to it, a set costs the sum.  Sets come off a heap in
    which a set is followed by "move the last border on" and "add the next border".
    """
    borders = sorted([(f * f, i, -1) for i, f in enumerate(fraction)] + [((1 - f) ** 2, i, 1) for i, f in enumerate(fraction)])
    out, heap = [[]], [(borders[0][0], (0,))]
    while heap and len(out) < n:
        cost, chosen = heapq.heappop(heap)
        if len({borders[x][1] for x in chosen}) == len(chosen):
            out.append([borders[x][1:] for x in chosen])
        last = chosen[-1]
        if last + 1 < len(borders):
            step = borders[last + 1][0]
            heapq.heappush(heap, (cost - borders[last][0] + step, (*chosen[:-1], last + 1)))
            heapq.heappush(heap, (cost + step, (*chosen, last + 1)))
    return out


def _mix(table: int, cells: np.ndarray) -> np.ndarray:
    """One long per bucket; buckets that share one only share candidates."""
    h = np.full(len(cells), 0x9E3779B97F4A7C15 * (table + 1) & (1 << 64) - 1, np.uint64)
    for c in cells.astype(np.int64).view(np.uint64).T:
        h = (h ^ c) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
    return h.view(np.int64)


class Hashes:
    def __init__(self, dim: int, norm: float, width: float):
        rng = np.random.default_rng(SEED)
        self.norm, self.width = norm, width
        self.a = rng.normal(size=(TABLES, dim + 1, HASHES))
        self.b = rng.uniform(0, width, size=(TABLES, HASHES))

    def cells(self, x: np.ndarray, table: int, query: bool) -> np.ndarray:
        """Positions in bucket widths; a query's added component is 0."""
        lift = np.zeros(len(x)) if query else np.sqrt(np.maximum(self.norm ** 2 - (x * x).sum(axis=1), 0))
        return (np.column_stack([x, lift]) @ self.a[table] + self.b[table]) / self.width

    def of_rows(self, x: np.ndarray):
        for t in range(TABLES):
            yield np.arange(len(x)), _mix(t, np.floor(self.cells(x, t, False)))

    def of_queries(self, x: np.ndarray, probes: int):
        for t in range(TABLES):
            at = self.cells(x, t, True)
            base = np.floor(at)
            who, cells = [], []
            for i, (f, b) in enumerate(zip(at - base, base)):
                for moves in probe_sets(f, probes):
                    cell = b.copy()
                    for h, s in moves:
                        cell[h] += s
                    who.append(i)
                    cells.append(cell)
            yield np.array(who, dtype=np.int64), _mix(t, np.array(cells).reshape(-1, HASHES))


def _packed(rows: DataFrame, norm: float, width: float, dim: int, query: bool, kind: str) -> DataFrame:
    """``bucket, ids, vectors``: the task's rows of each bucket, packed in blocks of bounded size."""
    def run(batches):
        hashes = Hashes(dim, norm, width)
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0).to_numpy()
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(ids), dim)
            x = flat.astype(np.float64)
            found = list(hashes.of_queries(x, PROBES) if query else hashes.of_rows(x))
            who, bucket = np.concatenate([w for w, _ in found]), np.concatenate([b for _, b in found])
            order = np.argsort(bucket, kind="stable")
            who, bucket = who[order], bucket[order]
            starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
            cuts = [c for a, b in zip(starts, np.r_[starts[1:], len(bucket)]) for c in range(a, b, BLOCK)] + [len(bucket)]
            for at in range(0, len(cuts) - 1, 4096):
                part = list(zip(cuts[at:at + 4096], cuts[at + 1:at + 4097]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket[[a for a, _ in part]]), pa.array([ids[who[a:b]].tobytes() for a, b in part], pa.binary()),
                     pa.array([flat[who[a:b]].astype(kind).tobytes() for a, b in part], pa.binary())],
                    names=["bucket", "ids", "vectors"])
    small = rows.mapInArrow(run, BLOCKS)
    return small.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_merge_blocks(dim * np.dtype(kind).itemsize), BLOCKS)


def _merge_blocks(row_bytes: int):
    """Join the blocks of a bucket that come one after the other, up to ``BLOCK`` rows."""
    def run(batches):
        bucket, ids, vectors, out = None, [], [], []

        def flush():
            if bucket is not None:
                x, v = b"".join(ids), b"".join(vectors)
                for at in range(0, len(x) // 8, BLOCK):
                    out.append((bucket, x[8 * at:8 * (at + BLOCK)], v[row_bytes * at:row_bytes * (at + BLOCK)]))

        def emit():
            columns = list(zip(*out)) or [[]] * 3
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.binary()),
                                               pa.array(columns[2], pa.binary())], names=["bucket", "ids", "vectors"])
        for batch in batches:
            for b, i, v in zip(*(c.to_pylist() for c in batch.columns)):
                if b != bucket or sum(map(len, ids)) >= 8 * BLOCK:
                    flush()
                    bucket, ids, vectors = b, [], []
                ids.append(i)
                vectors.append(v)
                if len(out) >= 1024:
                    yield emit()
        flush()
        yield emit()
    return run


class Best:
    """The ``k`` best candidates of each query that a task has seen: exact scores, ties to the smaller id."""

    def __init__(self, k: int):
        self.k, self.held, self.n, self.least = k, [], 0, {}

    def add(self, q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray) -> None:
        """Candidates ``x`` for queries ``q``: a matrix product leaves out those that cannot be among the best."""
        rough = q @ x.T
        rough[q_ids[:, None] == ids[None, :]] = -np.inf
        least = np.array([self.least.get(i, -np.inf) for i in q_ids.tolist()])
        if len(ids) > self.k:
            least = np.maximum(least, np.partition(rough, len(ids) - self.k, axis=1)[:, len(ids) - self.k])
        off = MARGIN * np.sqrt((q * q).sum(axis=1).max() * (x * x).sum(axis=1).max())
        i, j = np.nonzero((rough >= least[:, None] - off) & (rough > -np.inf))
        for at in range(0, len(i), STEP // x.shape[1]):
            a, b = i[at:at + STEP // x.shape[1]], j[at:at + STEP // x.shape[1]]
            self.held.append((q_ids[a], ids[b], (q[a] * x[b]).sum(axis=1)))
        self.n += len(i)
        if self.n > PENDING:
            self.shrink()

    def shrink(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        q, v, s = (np.concatenate(x) for x in zip(*self.held)) if self.held else (np.zeros(0, np.int64),) * 2 + (np.zeros(0),)
        order = np.lexsort((v, -s, q))
        q, v, s = q[order], v[order], s[order]
        again = np.r_[False, (q[1:] == q[:-1]) & (v[1:] == v[:-1]) & (s[1:] == s[:-1])] if len(q) else np.zeros(0, bool)
        q, v, s = q[~again], v[~again], s[~again]
        starts = np.flatnonzero(np.r_[True, q[1:] != q[:-1]]) if len(q) else np.zeros(0, int)
        rank = np.arange(len(q)) - np.repeat(starts, np.diff(np.r_[starts, len(q)]))
        full = rank == self.k - 1
        self.least.update(zip(q[full].tolist(), s[full].tolist()))
        keep = rank < self.k
        self.held, self.n = [(q[keep], v[keep], s[keep])], int(keep.sum())
        return self.held[0]


def _width(rows: DataFrame, n: int, norm: float, k: int) -> float:
    """``WIDTH`` times the median distance of the k-th neighbour that is no near copy, estimated on the sample."""
    picked = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()
    x = np.array([r["v"] for r in picked], dtype=np.float64)
    rank = min(len(x) - 2, max(1, round(k * len(x) / n)))
    if rank < 1:
        return norm * WIDTH
    queries = x[:SAMPLE_QUERIES]
    squared = norm ** 2 + (queries ** 2).sum(axis=1)[:, None] - 2 * queries @ x.T      # to the lifted rows
    apart = (queries ** 2).sum(axis=1)[:, None] + (x ** 2).sum(axis=1)[None, :] - 2 * queries @ x.T
    squared[apart < (NEAR * norm) ** 2] = np.inf                                      # itself and near copies
    kth = np.sort(squared, axis=1)[:, rank - 1]
    kth = kth[np.isfinite(kth)]
    return float(WIDTH * max(np.sqrt(max(np.median(kth), 0.0)) if len(kth) else norm, NEAR * norm))


def search(vectors: DataFrame, k: int = NEIGHBOURS, every: int = EVERY, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row whose id is divisible by ``every``, its ``k`` nearest found.

    Nearest is the largest inner product (in double precision), ties go to the
    smaller id; all rows but those with the query's id are candidates.  Rows
    that are not ``usable`` take no part, nor do vectors that have not the most
    frequent number of components (ties: the larger).  Of equal vectors only
    the ``k + 1`` smallest ids can be among the nearest, so only those are
    indexed.  A query for which the buckets hold fewer than ``k`` others (or
    none at all) is compared with all rows, in blocks, so a list is short only
    where there are no more rows.  Repeated rows count once; an empty table
    gives no rows.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vector_col)
    kind = "f4" if "float" in dict(rows.dtypes)["v"] else "f8"
    dims = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    schema = "query_id long, rank int, vec_id long, score double"
    if not dims:
        return spark.createDataFrame([], schema)
    dim = dims[0]["d"]
    same = Window.partitionBy("v").orderBy("vec_id")
    queries = rows.where((F.size("v") == dim) & (F.col("vec_id") % every == 0))
    rows = (rows.where(F.size("v") == dim).withColumn("_n", F.dense_rank().over(same)).where(F.col("_n") <= k + 1).drop("_n"))
    rows = checkpointed(rows)
    squares = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    n, norm = rows.agg(F.count("*"), F.sqrt(F.max(squares))).first()
    width = _width(rows, n, norm, k)
    index = _packed(rows, norm, width, dim, False, kind)
    probes = _packed(queries, norm, width, dim, True, kind)
    met = index.join(probes.select("bucket", F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors")), "bucket").select(
        "ids", "vectors", "q_ids", "q_vectors")

    def rerank(batches):
        best = Best(k)
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                ids, q_ids = np.frombuffer(row[0], np.int64), np.frombuffer(row[2], np.int64)
                x = np.frombuffer(row[1], kind).reshape(-1, dim).astype(np.float64)
                q = np.frombuffer(row[3], kind).reshape(-1, dim).astype(np.float64)
                best.add(q_ids, q, ids, x)
        q, v, s = best.shrink()
        for at in range(0, len(q), 10_000):
            part = slice(at, at + 10_000)
            yield pa.RecordBatch.from_arrays([pa.array(q[part]), pa.array(v[part]), pa.array(s[part])], names=["query_id", "vec_id", "score"])
    scores = "query_id long, vec_id long, score double"
    found = checkpointed(met.mapInArrow(rerank, scores).groupBy("query_id", "vec_id").agg(F.max("score").alias("score")))

    enough = found.groupBy("query_id").count().where(F.col("count") >= k).select("query_id")
    short = queries.join(enough, F.col("vec_id") == F.col("query_id"), "left_anti").select(
        F.col("vec_id").alias("q_id"), F.col("v").cast("array<double>").alias("q"))
    short = checkpointed(short.dropDuplicates(["q_id", "q"]))
    if not short.isEmpty():
        part = (F.pmod(F.xxhash64("q_id", "q"), F.lit(max(1, -(-short.count() // SCAN))))).alias("part")
        blocks = short.groupBy(part).agg(F.collect_list(F.struct("q_id", "q")).alias("qs")).select("qs")
        packs = rows.select("vec_id", F.col("v").cast("array<double>").alias("v")).groupBy(
            F.pmod(F.xxhash64("vec_id"), F.lit(-(-n // BLOCK))).alias("part")).agg(F.collect_list(F.struct("vec_id", "v")).alias("xs"))

        def scan(batches):
            best = Best(k)
            for batch in batches:
                for qs, xs in zip(batch.column(0), batch.column(1)):
                    (q_ids, q), (ids, x) = ((p.values.field(0).to_numpy(), p.values.field(1).flatten().to_numpy().reshape(-1, dim))
                                            for p in (qs, xs))
                    best.add(q_ids, q, ids, x)
            q, v, s = best.shrink()
            yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(v), pa.array(s)], names=["query_id", "vec_id", "score"])
        scanned = blocks.crossJoin(packs.select("xs")).mapInArrow(scan, scores)
        found = found.unionByName(scanned).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    nearest = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
