"""Exact top-k inner-product search: a ball tree per shard, branch and bound.

Every shard of the candidate vectors is a packed ball tree.  A block of queries descends it together: a node is
entered only by the queries whose upper bound (q.c + |q| r) reaches their current k-th score, the side with the
larger bound first.  The k-th scores are shared: a pilot shard gives every query a first one, and a task hands the
running one from shard to shard.  Trees stay in the tasks that read their rows: queries come to them, in rounds of
``QUERY_BYTES`` of packed queries, each a broadcast of bounded size, and only a task's best k a query are shuffled; so
what is shuffled grows with rows of results (queries x tasks x k at most), not with vectors.

Components become floor(64 * x) (x as double) and scores are exact integers.  Defined results: vectors that are null,
empty or hold null or non-finite components, and rows without an id, take no part; vectors of unlike lengths score as
if padded by zeros; ties go to the smaller id.  An id given by several valid rows is one query (its first vector in
order); the query's own row is one row of that id and vector, and its other rows are candidates like any; scores beyond
64 bits saturate.  An empty table, or one without a valid query, gives no rows.
"""

from __future__ import annotations

import math
import pickle

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed

LEAF, SHARD_ROWS = 256, 8192
#: Packed queries of one round, and queries that descend a tree together.
QUERY_BYTES, BLOCK = 16 << 20, 2048
#: Rows of the shard that gives first k-th scores.
PILOT_ROWS = 4096
_LOW = np.iinfo(np.int64).min


def quantised(batch_ids: pa.Array, vectors: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids and integer vectors of the rows that take part (int64, or objects where 64 bits don't hold them)."""
    ids, rows = [], []
    for i, v in zip(batch_ids.to_pylist(), vectors.to_pylist()):
        if i is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        ids.append(i)
        rows.append(v)
    width = max(map(len, rows), default=0)
    if any(len(v) != width for v in rows):
        rows = [[*v, *[0.0] * (width - len(v))] for v in rows]
    made = np.floor(64 * np.array(rows, dtype=np.float64).reshape(len(rows), width))
    if made.size and np.abs(made).max() >= 2.0**31:
        out = np.empty(made.shape, dtype=object)
        out[:] = [[int(x) for x in row] for row in made]
        return np.array(ids, dtype=np.int64), out
    top = float(np.abs(made).max(initial=0))
    return np.array(ids, dtype=np.int64), made.astype(np.int8 if top < 2**7 else np.int16 if top < 2**15 else np.int32)


def _products(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Exact integer inner products."""
    width = max(q.shape[1], v.shape[1])
    q, v = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) if x.shape[1] < width else x for x in (q, v))
    if q.dtype != object and v.dtype != object:
        a, b = q.astype(np.float64), v.astype(np.float64)
        if not a.size or not b.size or float(np.abs(a).max()) * float(np.abs(b).max()) * width < 2.0**52:
            return (a @ b.T).astype(np.int64)
    exact = q.astype(object) @ v.astype(object).T
    return np.clip(exact, _LOW + 1, np.iinfo(np.int64).max).astype(np.int64)


class BallTree:
    """Rows reordered so that every node is a slice; nodes are split at the median of the widest direction."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF) -> None:
        self.leaf = leaf
        order = np.arange(len(ids))
        floats = vectors.astype(np.float64)
        self.nodes: list[tuple[int, int, np.ndarray, float, int, int]] = []
        self._build(floats, order, 0, len(ids))
        self.ids, self.vectors = ids[order], vectors[order]

    def _build(self, floats: np.ndarray, order: np.ndarray, lo: int, hi: int) -> int:
        rows = floats[order[lo:hi]]
        centre = rows.mean(axis=0)
        radius = float(np.sqrt(((rows - centre) ** 2).sum(axis=1).max()))
        at = len(self.nodes)
        self.nodes.append((lo, hi, centre, radius, -1, -1))
        if hi - lo > self.leaf and radius > 0:
            far = rows[((rows - centre) ** 2).sum(axis=1).argmax()]
            mid = (hi - lo) // 2
            order[lo:hi] = order[lo:hi][np.argpartition((rows - centre) @ (far - centre), mid)]
            left = self._build(floats, order, lo, lo + mid)
            right = self._build(floats, order, lo + mid, hi)
            self.nodes[at] = (lo, hi, centre, radius, left, right)
        return at

    def search(self, best: TopK) -> None:
        if len(self.ids):
            bounds = self._bounds(best)
            self._visit(0, np.arange(len(best.queries)), best, bounds)

    def _bounds(self, best: TopK) -> np.ndarray:
        """Upper bounds of every query at every node, with room for rounding."""
        centres = np.array([n[2] for n in self.nodes])
        q = best.floats
        width = max(q.shape[1], centres.shape[1])
        q, centres = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (q, centres))
        radii = np.array([n[3] for n in self.nodes])
        reach = q @ centres.T + best.norms[:, None] * radii
        return reach + 1e-9 * (np.abs(reach) + best.norms[:, None] * np.abs(centres).max(initial=0) * width) + 1e-6

    def _visit(self, at: int, active: np.ndarray, best: TopK, bounds: np.ndarray) -> None:
        active = active[bounds[active, at] >= best.kth[active]]
        if not len(active):
            return
        lo, hi, _, _, left, right = self.nodes[at]
        if left < 0:
            best.offer(active, self.ids[lo:hi], self.vectors[lo:hi])
            return
        nearer = bounds[active, left] >= bounds[active, right]
        for first, second, group in ((left, right, active[nearer]), (right, left, active[~nearer])):
            self._visit(first, group, best, bounds)
            self._visit(second, group, best, bounds)


class TopK:
    """The best k (score, id) of each query so far, and its k-th score (a given bound until k are known)."""

    def __init__(self, query_ids: np.ndarray, queries: np.ndarray, k: int, kth: np.ndarray | None = None) -> None:
        self.query_ids, self.queries, self.k = query_ids, queries, k
        self.floats = queries.astype(np.float64)
        self.norms = np.sqrt((self.floats**2).sum(axis=1))
        self.scores = np.full((len(queries), k), _LOW, dtype=np.int64)
        self.ids = np.zeros((len(queries), k), dtype=np.int64)
        self.kth = np.full(len(queries), _LOW, dtype=np.int64) if kth is None else kth.copy()

    def offer(self, active: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
        scores = _products(self.queries[active], vectors)
        live = (scores >= self.kth[active][:, None]) & (scores > _LOW)
        some = live.any(axis=1)
        active, scores = active[some], np.where(live[some], scores[some], _LOW)
        if not len(active):
            return
        all_scores = np.concatenate([self.scores[active], scores], axis=1)
        all_ids = np.concatenate([self.ids[active], np.broadcast_to(ids, scores.shape)], axis=1)
        order = _top(all_scores, all_ids, self.k)
        self.scores[active] = np.take_along_axis(all_scores, order, axis=1)
        self.ids[active] = np.take_along_axis(all_ids, order, axis=1)
        self.kth[active] = np.maximum(self.kth[active], self.scores[active, -1])

    def rows(self) -> pd.DataFrame:
        at, col = np.nonzero(self.scores > _LOW)
        # of the rows that look like the query's own (there is one, copies of it aside), the caller drops one
        whole = np.concatenate([np.diagonal(_products(self.queries[i : i + 64], self.queries[i : i + 64])) for i in range(0, len(self.queries), 64)])
        own = (self.ids[at, col] == self.query_ids[at]) & (self.scores[at, col] == whole[at])
        return pd.DataFrame({"query_id": self.query_ids[at], "vec_id": self.ids[at, col], "score": self.scores[at, col], "own": own})


def _top(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k first of each row by (score descending, id)."""
    by_id = np.argsort(ids, axis=1, kind="stable")
    by_score = np.argsort(~np.take_along_axis(scores, by_id, axis=1), axis=1, kind="stable")[:, :k]  # ~x falls as x rises
    return np.take_along_axis(by_id, by_score, axis=1)


def _stacked(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    wide = max(v.shape[1] for _, v in held)
    return np.concatenate([i for i, _ in held]), np.concatenate([np.pad(v, ((0, 0), (0, wide - v.shape[1]))) for _, v in held])


def _shards(batches):
    """The valid rows of a task, SHARD_ROWS or so at a time."""
    held, size = [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, SHARD_ROWS):
            part = batch.slice(at, SHARD_ROWS)
            ids, made = quantised(part.column(0), part.column(1))
            if len(ids):
                held.append((ids, made))
                size += len(ids)
            if size >= SHARD_ROWS:
                yield _stacked(held)
                held, size = [], 0
    if held:
        yield _stacked(held)


def _query_rounds(rows: DataFrame, every: int, pilot):
    """(ids, vectors, first k-th scores) of the distinct query ids, QUERY_BYTES of packed vectors at a time."""

    def pack(batches):
        for batch in batches:
            ids, made = quantised(batch.column(0), batch.column(1))
            yield pa.RecordBatch.from_pydict({"id": pa.array(ids), "v": pa.array([pickle.dumps(x) for x in made], pa.binary())})

    def bound(batches):
        tree, k = pilot.value
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                best = TopK(part.column(0).to_numpy(), _matrix(part.column(1).to_pylist()), k)
                if tree is not None:
                    tree.search(best)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(best.kth)], names=["id", "v", "kth"])

    # an id in several rows is asked by the first of its vectors in order
    asked = rows.filter(F.col("id") % every == 0).mapInArrow(pack, "id long, v binary").groupBy("id").agg(F.min("v").alias("v"))
    asked = checkpointed(asked.mapInArrow(bound, "id long, v binary, kth long"))
    size = asked.agg(F.sum(F.octet_length("v").cast("long") + 16)).first()[0] or 0
    rounds = max(1, -(-size // QUERY_BYTES))
    for r in range(rounds):
        part = asked if rounds == 1 else asked.filter(F.pmod(F.xxhash64("id"), F.lit(rounds)) == r)
        got = part.toPandas()  # QUERY_BYTES or so
        if len(got):
            yield got["id"].to_numpy(dtype=np.int64), _matrix(got["v"]), got["kth"].to_numpy(dtype=np.int64)


def _matrix(packed) -> np.ndarray:
    vectors = [pickle.loads(x) for x in packed]
    wide = max(map(len, vectors), default=0)
    return np.array([np.pad(x, (0, wide - len(x))) for x in vectors]).reshape(len(vectors), wide)


def exact_topk(vectors: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows of every query (ids divisible by ``every``)."""
    spark = vectors.sparkSession
    rows = vectors.select(vectors[id_col].cast("long").alias("id"), vectors[vector_col].alias("v")).filter("id IS NOT NULL AND v IS NOT NULL")
    more = k + 1  # the query's own row may be among them
    pilot = next(_shards(rows.limit(PILOT_ROWS).toArrow().to_batches()), None)  # a bounded shard, for first k-th scores
    pilot = spark.sparkContext.broadcast((BallTree(*pilot) if pilot else None, more))
    found = None
    for asked in _query_rounds(rows, every, pilot):
        shared = spark.sparkContext.broadcast(asked)  # QUERY_BYTES or so

        def search(batches, shared=shared):
            ids, queries, kth = shared.value
            blocks = [TopK(ids[i : i + BLOCK], queries[i : i + BLOCK], more, kth[i : i + BLOCK]) for i in range(0, len(ids), BLOCK)]
            for shard in _shards(batches):
                tree = BallTree(*shard)
                for best in blocks:
                    tree.search(best)
            for best in blocks:
                yield pa.RecordBatch.from_pandas(best.rows(), preserve_index=False)

        part = rows.mapInArrow(search, "query_id long, vec_id long, score long, own boolean")
        found = part if found is None else found.union(part)
    if found is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id", F.desc("own"))
    kept = found.withColumn("at", F.row_number().over(best)).filter(F.col("at") <= more)
    # one own row goes, and those behind it move up
    own_at = F.min(F.when(F.col("own"), F.col("at"))).over(Window.partitionBy("query_id"))
    kept = kept.withColumn("own_at", own_at).filter(F.col("own_at").isNull() | (F.col("at") != F.col("own_at")))
    rank = F.when(F.col("at") > F.col("own_at"), F.col("at") - 1).otherwise(F.col("at"))
    return kept.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
