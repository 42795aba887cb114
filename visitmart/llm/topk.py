"""Exact top-k by inner product with a KD-tree per shard.

Components are turned into integers, floor(scale * x), so scores are exact and
ties are real; of equal scores the smaller id is better. Rows are dealt to
shards by a hash of the id. A shard collapses equal vectors (keeping the k + 1
smallest ids, enough for k results beside the query's own row) and builds a
KD-tree: median splits on the widest dimension, tight bounding boxes, the
smallest id below each node. A query walks the tree best-first by the bound
``sum(max(q * low, q * high))`` of a box and stops when no box can beat its kth
result, by score or, at equal score, by id.

The kth score travels: each query first searches its own shard, then goes to
all other shards with the kth score it found, which prunes there from the start.
Queries come in blocks; a block meets a shard once. Each shard returns at most k
rows for a query, so the final ranking sees k rows per query and shard.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

LEAF = 256
NO_ID = np.iinfo(np.int64).max


class KDTree:
    """Nodes over distinct integer vectors, with the smallest ids of each."""

    def __init__(self, vectors: np.ndarray, ids: list[np.ndarray], leaf: int = LEAF):
        self.leaf, self.vectors, self.ids = leaf, vectors, ids
        self.first_id = np.array([i[0] for i in ids], np.int64)
        self.order = np.arange(len(vectors))
        self.low, self.high, self.span, self.kids, self.least = [], [], [], [], []
        if len(vectors):
            self._build(0, len(vectors))
            self.low, self.high = np.array(self.low), np.array(self.high)

    def _build(self, a: int, z: int) -> int:
        me = len(self.span)
        rows = self.order[a:z]
        v = self.vectors[rows]
        low, high = v.min(0), v.max(0)
        for store, x in ((self.low, low), (self.high, high), (self.span, (a, z)), (self.kids, None), (self.least, int(self.first_id[rows].min()))):
            store.append(x)
        if z - a > self.leaf:
            mid = (z - a) // 2
            self.order[a:z] = rows[np.argpartition(v[:, int((high - low).argmax())], mid)]
            self.kids[me] = (self._build(a, a + mid), self._build(a + mid, z))
        return me

    def search(self, q: np.ndarray, k: int, own: int, floor: int | None = None) -> list[tuple[int, int]]:
        """Best (score, id) of other ids, best first; scores below ``floor`` may be left out."""
        if not len(self.vectors):
            return []
        bound = lambda n: int(np.maximum(q * self.low[n], q * self.high[n]).sum())
        todo, best = [(-bound(0), self.least[0], 0)], []      # best: heap of (score, -id), worst first
        while todo:
            upper, least, n = heapq.heappop(todo)
            upper = -upper
            if floor is not None and upper < floor or len(best) == k and (upper, -least) <= best[0]:
                if floor is not None and upper < floor or upper < best[0][0]:
                    break
                continue
            if self.kids[n]:
                for c in self.kids[n]:
                    heapq.heappush(todo, (-bound(c), self.least[c], c))
                continue
            rows = self.order[self.span[n][0]:self.span[n][1]]
            scores = self.vectors[rows] @ q
            low = best[0][0] if len(best) == k else floor
            take = np.arange(len(rows)) if low is None else np.flatnonzero(scores >= low)
            if len(take) > 4 * k:                              # the best by (score, id), with room for the query's own row
                take = take[np.lexsort((self.first_id[rows[take]], -scores[take]))[:k + 1]]
            for r, s in zip(rows[take].tolist(), scores[take].tolist()):
                for i in self.ids[r].tolist():
                    if i == own:
                        continue
                    if len(best) < k:
                        heapq.heappush(best, (s, -i))
                    elif (s, -i) > best[0]:
                        heapq.heapreplace(best, (s, -i))
                    else:
                        break
        return [(s, -i) for s, i in sorted(best, reverse=True)]


def build_shard(ids: np.ndarray, vectors: np.ndarray, k: int) -> KDTree:
    """Collapse equal vectors; keep the k + 1 smallest ids of each."""
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], np.ascontiguousarray(vectors[order])
    raw = vectors.view([("", vectors.dtype)] * vectors.shape[1]).ravel() if len(ids) else vectors[:, 0]
    _, first, inverse = np.unique(raw, return_index=True, return_inverse=True)
    by = np.argsort(inverse, kind="stable")
    groups = np.split(ids[by], np.cumsum(np.bincount(inverse))[:-1]) if len(ids) else []
    return KDTree(vectors[first], [g[:k + 1] for g in groups])


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int64).reshape(-1, dim)


def quantised(table: DataFrame, id_col: str, vector: str, scale: int) -> DataFrame:
    """(id, dim, v) of the rows that take part; v holds 64-bit integers."""

    def run(batches):
        for batch in batches:
            lists = batch.column(1)
            n = len(lists)
            flat = lists.flatten().cast(pa.float64())
            off = lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()
            size = np.diff(off)
            size[lists.is_null().to_numpy(zero_copy_only=False)] = 0
            x = flat.to_numpy(zero_copy_only=False)            # a null component reads as NaN
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(x))])
            ok = (bad[off[1:]] == bad[off[:-1]]) & (size > 0) & batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            with np.errstate(invalid="ignore"):
                scaled = np.floor(np.where(np.isfinite(x), x, 0) * float(scale))
            keep = np.flatnonzero(ok)
            if np.abs(scaled[np.repeat(ok, size)]).max(initial=0) >= 1 << 26:      # before the cast, which would wrap
                raise ValueError("a scaled component is 2**26 or more")
            with np.errstate(invalid="ignore"):
                q = scaled.astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep)), pa.array(size[keep], pa.int32()),
                                              pa.array([q[off[i]:off[i + 1]].tobytes() for i in keep], pa.binary())],
                                             names=["id", "dim", "v"])

    slim = table.select(F.col(id_col).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    return slim.mapInArrow(run, "id long, dim int, v binary")


def top_k(table: DataFrame, id_col: str = "vec_id", vector: str = "embedding", k: int = 5, scale: int = 256,
          is_query=None, rows_per_shard: int = 20_000, block: int = 50_000) -> DataFrame:
    """query_id, rank, vec_id, score: for each query row the k best other rows.

    Vectors that are null, empty, or hold null or non-finite components take no
    part, nor do null ids. Only vectors of the query's length are scored. Rows
    that share the query's id are its own. Repeated rows are one candidate
    (results name ids). A query without candidates has no rows. Scaled
    components must stay under 2**26, so that scores are exact.

    A task holds one shard (``rows_per_shard`` rows) and one block of queries.
    """
    vecs = materialize(quantised(table, id_col, vector, scale).distinct())
    shards = max(1, -(-vecs.count() // rows_per_shard))
    rows = vecs.select(F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("shard"), "dim", "id", "v")
    queries = rows.filter(is_query(F.col("id"))) if is_query is not None else rows
    blocks = max(1, -(-queries.count() // block))
    queries = materialize(queries.withColumn("block", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks)).cast("int")))
    rows = rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def search(data: pa.Table, asked: pa.Table) -> pa.Table:
        out = []
        if data.num_rows and asked.num_rows:
            dim = data["dim"][0].as_py()
            tree = build_shard(data["id"].to_numpy(), _matrix(data["v"], dim), k)
            for own, q, floor in zip(asked["id"].to_pylist(), _matrix(asked["v"], dim), asked["floor"].to_pylist()):
                out += [(own, vec, score) for score, vec in tree.search(q, k, own, floor)]
        return pa.table({name: pa.array([r[i] for r in out], pa.int64()) for i, name in enumerate(("query_id", "vec_id", "score"))})

    keys = ["shard", "dim", "block"]
    by_shard, schema = rows.groupBy(*keys), "query_id long, vec_id long, score long"
    home = queries.select(*keys, "id", "v", F.lit(None).cast("long").alias("floor"))
    found = by_shard.cogroup(home.groupBy(*keys)).applyInArrow(search, schema)
    if shards > 1:
        found = materialize(found)
        kth = found.groupBy(F.col("query_id").alias("id")).agg(F.count("*").alias("c"), F.min("score").alias("s")) \
            .select("id", F.when(F.col("c") >= k, F.col("s")).alias("floor"))
        asked = queries.join(kth, "id", "left").withColumnRenamed("shard", "own") \
            .select("dim", "block", "id", "v", "floor", "own", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")) \
            .filter("shard != own").drop("own")
        found = found.unionByName(by_shard.cogroup(asked.groupBy(*keys)).applyInArrow(search, schema))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op7_top_k(spark, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), is_query=lambda c: c % 50 == 0)


OP7_SQL = """
WITH v AS (
  SELECT vec_id, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
