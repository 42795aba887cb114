"""Ranked lexical search by dense blocked matrix products.

Terms are compared byte for byte. One pass over the texts counts each document's
terms and keeps the counts of those that items ask for; statistics are sums over
all documents. Then documents meet items in tiles: a tile of items has a compact
vocabulary of its own, cut into column tiles, and its rows hold repeats times term
weight; a tile of documents holds the terms' impacts in the same columns. Both are
float64 matrices of integers, multiplied by BLAS. Columns are cut so that no
partial sum can reach 2**53: every product is exact, whatever the order of its
additions, and column tiles add up in 64-bit integers.

Each task keeps the k best documents per item: a tile's scores are first held
against the kth best so far (at equal score by id), so ties come out right and few
entries are sorted. The final ranking sees k rows per item and task.

Items come in blocks of bounded text, each with one pass over the documents.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .arrays import LOWER, release
from .ordered import running

TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
OTHER = re.compile(rb"[^0-9a-z\x80-\xff]")
LOWER_TABLE = LOWER.tobytes()
PIECE = 1 << 20
EXACT = 1 << 53
# Fixed values of the score: impact = SCALE * tf div (STEP * tf + SATURATION * m), under SCALE / STEP;
# m = 100 - SHARE + (SHARE * n * N) div L.
SCALE, STEP, SATURATION, SHARE = 1_000_000_000, 1000, 12, 25
TOP_IMPACT = SCALE // STEP


# -- terms ---------------------------------------------------------------------

def terms(text: str | None, piece: int = PIECE) -> Counter:
    """The terms of a text and how often they occur; a long text is read in pieces."""
    low, at, out = (text or "").encode().translate(LOWER_TABLE), 0, Counter()
    while at < len(low):
        stop = OTHER.search(low, at + piece)
        end = stop.start() if stop else len(low)
        out.update(TERM.findall(low, at, end))
        at = end
    return out


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    tf = tf.astype(np.int64)
    return SCALE * tf // (STEP * tf + SATURATION * m)


def counts(docs: DataFrame, text: str, id_col: str, vocabulary: list[bytes]) -> DataFrame:
    """(doc_id, n, terms, tf) of the documents that have terms: their number, and
    places in the vocabulary with counts."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        place = {t: i for i, t in enumerate(shared.value)}
        for batch in batches:
            keep, n, at, tf, size = [], [], [], [], [0]
            for row, x in enumerate(batch.column(1)):
                found = terms(x.as_py())
                if found:
                    keep.append(row)
                    n.append(found.total())
                    hit = [(place[t], c) for t, c in found.items() if t in place]
                    at += [i for i, _ in hit]
                    tf += [c for _, c in hit]
                    size.append(len(at))
            size = pa.array(size, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(keep, pa.int64())), pa.array(n, pa.int64()), pa.ListArray.from_arrays(size, pa.array(at, pa.int32())),
                 pa.ListArray.from_arrays(size, pa.array(tf, pa.int64()))], names=["doc_id", "n", "terms", "tf"])
            release()

    slim = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return slim.mapInArrow(run, "doc_id long, n long, terms array<int>, tf array<bigint>")


# -- tiles ---------------------------------------------------------------------

class ItemTile:
    """Some items: a compact vocabulary in column tiles, each with the matrix of
    repeats * weight (items x columns)."""

    def __init__(self, items: list[tuple[int, dict[int, int]]], weights: np.ndarray, columns: int, limit: int = EXACT // TOP_IMPACT):
        self.items = np.array([i for i, _ in items], np.int64)
        entries = sorted((t, row, q * int(weights[t])) for row, (_, wants) in enumerate(items) for t, q in wants.items() if weights[t])
        self.tiles, open_, sums = [], {}, [0] * len(items)      # open_: column -> {row: value}

        def close():
            if open_:
                matrix = np.zeros((len(items), len(open_)))
                for c, rows in enumerate(open_.values()):
                    for row, value in rows.items():
                        matrix[row, c] = value
                self.tiles.append((np.fromiter(open_, np.int64, len(open_)), matrix))
                open_.clear()
                sums[:] = [0] * len(items)

        for t, row, value in entries:
            while value:                                       # a value beyond the bound is spread over tiles
                if sums[row] == limit or len(open_) >= columns and t not in open_:
                    close()
                part = min(value, limit - sums[row])
                rows = open_.setdefault(t, {})
                rows[row] = rows.get(row, 0) + part
                sums[row] += part
                value -= part
        close()

    def scores(self, row: np.ndarray, term: np.ndarray, impact: np.ndarray, n_docs: int, size: int) -> np.ndarray:
        """(items x documents) int64 scores of documents given by (row, term, impact) entries."""
        total = np.zeros((len(self.items), n_docs), np.int64)
        column = np.full(size, -1, np.int64)
        for at, matrix in self.tiles:
            column[at] = np.arange(len(at))
            c = column[term]
            hit = np.flatnonzero(c >= 0)
            column[at] = -1
            used, c = np.unique(c[hit], return_inverse=True)   # only columns that these documents have
            dense = np.zeros((len(used), n_docs))
            dense[c, row[hit]] = impact[hit]
            total += (matrix[:, used] @ dense).astype(np.int64)
        return total


class Best:
    """The k best (score, id) per item, higher scores and then smaller ids first."""

    def __init__(self, n_items: int, k: int):
        self.k = k
        self.item, self.score, self.id, self.null = (np.zeros(0, x) for x in (np.int64, np.int64, np.int64, bool))
        self.kth, self.last = np.zeros(n_items, np.int64), np.full(n_items, np.iinfo(np.int64).min)

    def add(self, first: int, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        """Scores of the items first, first + 1, ... for documents ``ids`` (null: largest)."""
        z = first + len(scores)
        kth, last = self.kth[first:z, None], self.last[first:z, None]
        i, d = np.nonzero((scores > kth) | (scores == kth) & (kth > 0) & (ids[None] <= last))
        if not len(i):
            return
        item, score = np.concatenate([self.item, i + first]), np.concatenate([self.score, scores[i, d]])
        id_, no = np.concatenate([self.id, ids[d]]), np.concatenate([self.null, null[d]])
        order = np.lexsort((id_, no, -score, item))
        item = item[order]
        start = np.flatnonzero(np.diff(item, prepend=-1))
        place = np.arange(len(item)) - np.repeat(start, np.diff(start, append=len(item)))
        keep = order[place < self.k]
        self.item, self.score, self.id, self.null = item[place < self.k], score[keep], id_[keep], no[keep]
        full = place[place < self.k] == self.k - 1             # below the kth nothing counts any more
        self.kth[self.item[full]] = self.score[full]
        self.last[self.item[full]] = np.where(self.null[full], np.iinfo(np.int64).max, self.id[full])


FOUND = "task int, item int, doc_id long, score long"


def scored(table: DataFrame, wants: list[dict[int, int]], weights: np.ndarray, n_docs: int, n_terms: int, k: int, items_per_tile: int,
           columns: int, docs_per_tile: int) -> DataFrame:
    """(task, item, doc_id, score): each task's k best documents of every item."""
    tiles = [ItemTile(list(enumerate(wants))[i:i + items_per_tile], weights, columns) for i in range(0, len(wants), items_per_tile)]
    shared = table.sparkSession.sparkContext.broadcast(tiles)

    def run(batches):
        best = Best(len(wants), k)
        for batch in batches:
            for a in range(0, batch.num_rows, docs_per_tile):
                docs = batch.slice(a, docs_per_tile)
                n, size = docs.column(1).to_pylist(), np.diff(docs.column(2).offsets.to_numpy())
                m = np.array([100 - SHARE + SHARE * x * n_docs // n_terms for x in n], np.int64)
                row = np.repeat(np.arange(len(n)), size)
                term = docs.column(2).flatten().to_numpy()
                impact = impacts(docs.column(3).flatten().to_numpy(), m[row])
                null = docs.column(0).is_null().to_numpy(zero_copy_only=False)
                ids = docs.column(0).fill_null(np.iinfo(np.int64).max).to_numpy()
                for tile in shared.value:
                    best.add(int(tile.items[0]), tile.scores(row, term, impact, len(n), len(weights)), ids, null)
        yield pa.RecordBatch.from_arrays(
            [pa.array([TaskContext.get().partitionId()] * len(best.item), pa.int32()), pa.array(best.item.astype(np.int32)),
             pa.array(best.id, mask=best.null), pa.array(best.score)], names=["task", "item", "doc_id", "score"])

    return table.mapInArrow(run, FOUND)


# -- the search ------------------------------------------------------------------

def _ranked(found: DataFrame, k: int, *by) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k)


def _block(docs: DataFrame, items: list, text: str, id_col: str, k: int, items_per_tile: int, columns: int, docs_per_tile: int) -> DataFrame | None:
    spark = docs.sparkSession
    asked = [terms(r["text"]) for r in items]
    vocabulary = sorted(set().union(*asked))
    table = materialize(counts(docs, text, id_col, vocabulary))
    n_docs, n_terms = table.agg(F.count("*"), F.sum("n")).first()
    if not n_docs or not vocabulary:
        return None
    df = table.select(F.explode("terms").alias("t")).groupBy("t").count().collect()      # at most a row per term of the block
    weights = np.zeros(len(vocabulary), np.int64)
    for t, n in df:
        weights[t] = weight(n_docs, n)
    place = {t: i for i, t in enumerate(vocabulary)}
    wants = [{place[t]: q for t, q in a.items()} for a in asked]
    found = scored(table, wants, weights, n_docs, n_terms, k, items_per_tile, columns, docs_per_tile)
    # Two steps, so that no task ranks what all tasks found for an item.
    found = _ranked(materialize(found), k, "item", F.pmod("task", F.lit(64))).drop("rank")
    names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(items)], "item int, item_id long")
    return _ranked(found, k, "item").join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, text: str = "text", id_col: str = "doc_id", item_text: str = "text", item_id: str = "item_id",
           k: int = 20, items_per_tile: int = 256, columns: int = 2048, docs_per_tile: int = 1024, block_bytes: int = 8 << 20) -> DataFrame:
    """item_id, rank, doc_id, score: for each item the k documents of highest score above 0.

    Null or empty text, of a document or an item: no terms; such documents do not
    count, such items have no rows. Very long texts are read whole, in pieces.
    Items that repeat in id and text are one; items of equal id and different text
    are ranked on their own, under the same id. Repeated documents are each counted
    and ranked; null ids rank after others of equal score. Empty tables: no rows.
    Other columns are not read, whatever their names.

    The driver and each task hold one block of items: about ``block_bytes`` of item
    text (one more item at most), with its vocabulary; each block reads the texts once.
    """
    asked = items.select(F.col(f"`{item_id}`").cast("long").alias("item_id"), F.col(f"`{item_text}`").alias("text")) \
        .filter("text IS NOT NULL").distinct().withColumn("size", F.octet_length("text").cast("long") + 64)
    asked = materialize(asked)
    asked = materialize(running(asked, ["item_id", "text"], "size", asked.count()).withColumn("block", F.floor(F.col("start") / block_bytes)))
    out = None
    for b in [r[0] for r in asked.select("block").distinct().sort("block").toLocalIterator()]:
        got = _block(docs, asked.filter(F.col("block") == b).collect(), text, id_col, k, items_per_tile, columns, docs_per_tile)
        if got is not None:
            got = materialize(got)
            out = got if out is None else out.unionByName(got)
    return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long") if out is None else out


def op11_lexical_search(spark, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_TERMS = r"""unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+'))"""
OP11_SQL = rf"""
WITH d AS (SELECT *, row_number() OVER () AS r FROM documents),
dt AS (SELECT r, doc_id, {_TERMS} AS term FROM d),
it AS (SELECT item_id, text, {_TERMS} AS term FROM (SELECT DISTINCT item_id, text FROM benchmark)),
q AS (SELECT item_id, text, term, count(*) AS q FROM it GROUP BY ALL),
size AS (SELECT r, count(*) AS n FROM dt GROUP BY r),
total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM size),
tf AS (SELECT r, doc_id, term, count(*) AS tf FROM dt WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, total GROUP BY term),
impact AS (SELECT tf.*, (1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms)) AS impact FROM tf JOIN size USING (r), total),
s AS (SELECT item_id, text, r, doc_id, sum(q * w * impact)::BIGINT AS score FROM q JOIN w USING (term) JOIN impact USING (term) GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id)::INTEGER AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""
