"""Removal of repeated passages by fixed-block anchors.

A passage is a run of at least ``window`` words that also stands in a document
with a smaller id. Each document is a reference: its non-overlapping blocks of
``(window + 1) // 2`` words are indexed. Each document is also a probe: every
rolling window of that length is looked up. Any passage holds a whole block of
the reference, so no passage is missed. Around the anchors that hit, the
windows are extended to ``window`` words and compared; overlapping hits join to
maximal exact repeats, whose words are removed.

Nothing is compared pair by pair. Per chunk of documents the distinct block
hashes go to buckets and one bit comes back: is it an indexed block that more
than one document holds? Then, for windows next to such anchors, the hash and
the smallest document of the chunk go out, and one bit comes back: is there a
smaller document elsewhere? A passage in a third of all documents costs one
record per chunk. The texts are dealt to chunks once; that shuffle is reused by
all three passes. Window identity is a 64-bit hash within a bucket.

Ids: rows of equal id do not repeat each other; a null id counts as larger than
all others. Null text: no words. Empty table: no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import U64, Words, ranges, release, text_buffer, window_hashes
from .exchange import (ANSWER, ASK, answer_table, answers, ask_table, from_planes, low_bucket, pack_sorted, plan, planes,
                       read_flags, split_buckets, unpack_sorted)

LAST = np.iinfo(np.int64).max


class Chunk:
    """Words and anchors of one chunk's documents."""

    def __init__(self, table: pa.Table, window: int, n_buckets: int):
        self.window, self.block, self.n_buckets = window, (window + 1) // 2, n_buckets
        ids = table["doc_id"].combine_chunks()
        self.null = ids.is_null().to_numpy(zero_copy_only=False)
        self.ids = ids.fill_null(LAST).to_numpy(zero_copy_only=False)
        self.raw, self.off = text_buffer(table["text"])
        self.w = Words(self.raw, self.off)
        self.hash = self.w.hashes()
        self.row = self.w.rows()
        self.long = self.w.counts >= window

    def _starts(self, n: int) -> np.ndarray:
        """Word positions where n words of one (long enough) document start."""
        count = np.where(self.long, np.maximum(self.w.counts - n + 1, 0), 0)
        return ranges(self.w.row_start, count)

    def anchors(self):
        """Sorted distinct records of rolling block windows."""
        at = self._starts(self.block)
        h = window_hashes(self.hash, self.block)[at]
        key = (low_bucket(h, self.n_buckets) << U64(32)) | (h >> U64(32))
        uniq, inverse = np.unique(key, return_inverse=True)
        row = self.row[at]
        indexed = np.zeros(len(uniq), bool)
        indexed[inverse[(at - self.w.row_start[row]) % self.block == 0]] = True
        last = np.zeros(len(uniq), np.int64)
        last[inverse] = row                                   # rows ascend, so this is the last one
        several = np.zeros(len(uniq), bool)
        several[inverse[row != last[inverse]]] = True
        return at, inverse, uniq, indexed, several

    def ask_anchors(self, chunk: int) -> pa.Table:
        _, _, uniq, indexed, several = self.anchors()
        rest = (uniq & U64(0xFFFFFFFF)).astype(np.uint32)
        bucket = uniq >> U64(32)
        return ask_table(chunk, [(b, z - a, pack_sorted(rest[a:z]) + np.packbits(indexed[a:z]).tobytes()
                                  + np.packbits(several[a:z]).tobytes()) for b, a, z in split_buckets(bucket, self.n_buckets)])

    def windows(self, got: dict[int, bytes]):
        """Full windows that hold an anchor that hit; sorted distinct hashes and
        the smallest document of each."""
        at, inverse, uniq, _, _ = self.anchors()
        hit = np.zeros(len(self.hash) + 1, np.int64)
        hit[at] = read_flags(got, uniq >> U64(32), self.n_buckets)[inverse]
        hit = np.concatenate([[0], np.cumsum(hit)])
        start = self._starts(self.window)
        start = start[hit[start + self.window - self.block + 1] > hit[start]]
        h = window_hashes(self.hash, self.window)[start]
        uniq, inverse = np.unique(h, return_inverse=True)
        least = np.full(len(uniq), LAST)
        np.minimum.at(least, inverse, self.ids[self.row[start]])
        return start, inverse, uniq, least

    def window_bucket(self, uniq: np.ndarray) -> np.ndarray:
        return (uniq >> U64(32)) * U64(self.n_buckets) >> U64(32)

    def ask_windows(self, chunk: int, got: dict[int, bytes]) -> pa.Table:
        _, _, uniq, least = self.windows(got)
        return ask_table(chunk, [(b, z - a, pack_sorted(uniq[a:z]) + planes(least[a:z]))
                                 for b, a, z in split_buckets(self.window_bucket(uniq), self.n_buckets)])

    def covered(self, anchors: dict[int, bytes], smaller: dict[int, bytes]) -> np.ndarray:
        """For each word: does a repeated window cover it?"""
        start, inverse, uniq, least = self.windows(anchors)
        other = read_flags(smaller, self.window_bucket(uniq), self.n_buckets)
        start = start[other[inverse] | (self.ids[self.row[start]] > least[inverse])]
        step = np.zeros(len(self.hash) + 1, np.int64)
        np.add.at(step, start, 1)
        np.add.at(step, start + self.window, -1)
        return np.cumsum(step)[:-1] > 0

    def result(self, covered: np.ndarray) -> pa.Table:
        """Per document: words, removed words, maximal repeats, kept text."""
        w, n_rows = self.w, len(self.ids)
        edge = np.flatnonzero(np.diff(np.concatenate([[0], covered.view(np.int8), [0]])))
        a, z = edge[0::2], edge[1::2]
        if len(a):                                              # a run may touch the next document's
            inner = w.row_start[1:][(w.row_start[1:] > 0) & (w.row_start[1:] < len(covered))]
            inner = np.unique(inner[covered[inner] & covered[inner - 1]])
            a, z = np.sort(np.concatenate([a, inner])), np.sort(np.concatenate([z, inner]))
        first = w.row_start[self.row[a]] if len(a) else a
        spans = np.searchsorted(self.row[a], np.arange(n_rows + 1)) if len(a) else np.zeros(n_rows + 1, int)
        pairs = np.stack([a - first, z - first], 1).ravel()
        kept = np.flatnonzero(~covered)
        size = (w.end - w.start)[kept] + 1                      # each word with the blank after it
        at = ranges(w.start[kept], size)
        text = np.append(self.raw, np.uint8(32))[at]
        ends = np.cumsum(size)
        text[ends - 1] = 32
        per_row = np.bincount(self.row[kept], minlength=n_rows)
        bytes_ = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(per_row)])]
        full = per_row > 0
        solid = np.ones(len(text), bool)
        solid[bytes_[1:][full] - 1] = False                     # no blank after a row's last word
        length = np.diff(bytes_) - full
        offsets = pa.array(np.concatenate([[0], np.cumsum(length)]), pa.int64())
        out = pa.LargeStringArray.from_buffers(n_rows, offsets.buffers()[1], pa.py_buffer(text[solid].tobytes()))
        ids = pa.array(self.ids, pa.int64(), mask=self.null)
        pair_list = pa.ListArray.from_arrays(pa.array(np.arange(0, len(pairs) + 1, 2), pa.int32()), pa.array(pairs, pa.int64()))
        return pa.table({"doc_id": ids, "n_words": pa.array(w.counts.astype(np.int64)),
                         "n_removed": pa.array((w.counts - per_row).astype(np.int64)),
                         "repeats": pa.ListArray.from_arrays(pa.array(spans, pa.int32()), pair_list),
                         "kept_text": out.cast(pa.string())})


def judge_anchors(asked: pa.Table) -> pa.Table:
    """Is the record an indexed block that more than one document holds?"""
    parts, flags = [], []
    for n, data in zip(asked["n"].to_pylist(), asked["payload"].to_pylist()):
        parts.append(unpack_sorted(data, n, np.uint32))
        half = (n + 7) // 8
        bits = np.frombuffer(data, np.uint8, offset=4 * n)
        flags.append(np.unpackbits(bits[:half], count=n) | np.unpackbits(bits[half:], count=n) << 1)
    both = (np.concatenate(parts).astype(U64) << U64(32)) | np.arange(sum(map(len, parts)), dtype=U64)
    both.sort()
    order, value, flag = (both & U64(0xFFFFFFFF)).astype(np.int64), both >> U64(32), np.concatenate(flags)
    flag = flag[order]
    first = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))
    size = np.diff(np.append(first, len(value)))
    any_ = np.bitwise_or.reduceat(flag, first)
    good = (any_ & 1 > 0) & ((size > 1) | (any_ & 2 > 0))
    out = np.zeros(len(value), bool)
    out[order] = np.repeat(good, size)
    return answer_table(asked, out)


def judge_windows(asked: pa.Table) -> pa.Table:
    """Does another chunk have this window in a smaller document?"""
    parts, least = [], []
    for n, data in zip(asked["n"].to_pylist(), asked["payload"].to_pylist()):
        parts.append(unpack_sorted(data, n, U64))
        least.append(from_planes(data[8 * n:], n, np.int64))
    value, least = np.concatenate(parts), np.concatenate(least)
    order = np.argsort(value, kind="stable")
    value = value[order]
    first = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))
    size = np.diff(np.append(first, len(value)))
    best = np.repeat(np.minimum.reduceat(least[order], first), size)
    out = np.zeros(len(value), bool)
    out[order] = best < least[order]
    return answer_table(asked, out)


def remove_repeats(docs: DataFrame, window: int = 13) -> DataFrame:
    """doc_id, n_words, n_removed, repeats (word ranges, end exclusive), kept_text
    (kept words joined by one blank) for each row. Reads doc_id and text only."""
    n_chunks, n_buckets = plan(docs)
    slim = docs.select(F.pmod(F.xxhash64("doc_id"), F.lit(n_chunks)).cast("int").alias("chunk"),
                       F.col("doc_id").cast("long"), F.col("text"))
    by_chunk = slim.groupBy("chunk")

    def one(table):
        return table["chunk"][0].as_py(), Chunk(table, window, n_buckets)

    def ask_anchors(table):
        chunk, c = one(table)
        out = c.ask_anchors(chunk)
        release()
        return out

    def ask_windows(table, got):
        if not table.num_rows:
            return ask_table(0, [])
        chunk, c = one(table)
        out = c.ask_windows(chunk, answers(got))
        release()
        return out

    def finish(table, got):
        _, c = one(table)
        kind = got["step"].to_numpy()
        out = c.result(c.covered(*(answers(got.filter(pa.array(kind == k))) for k in (1, 2))))
        release()
        return out

    anchors = by_chunk.applyInArrow(ask_anchors, ASK).groupBy("bucket").applyInArrow(judge_anchors, ANSWER)
    windows = (by_chunk.cogroup(anchors.groupBy("chunk")).applyInArrow(ask_windows, ASK)
               .groupBy("bucket").applyInArrow(judge_windows, ANSWER))
    both = anchors.withColumn("step", F.lit(1)).unionByName(windows.withColumn("step", F.lit(2)))
    return by_chunk.cogroup(both.groupBy("chunk")).applyInArrow(
        finish, "doc_id long, n_words long, n_removed long, repeats array<array<long>>, kept_text string")


def op5_substring_dedup(spark, sf_dir: str) -> DataFrame:
    out = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 12], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 11, 1))) AS i FROM d)),
hit AS (SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY h) AS m FROM win) WHERE m < doc_id),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM hit, (SELECT unnest(range(0, 13)) AS k)),
gone_list AS (SELECT doc_id, list(i) AS g, count(*) AS n FROM gone GROUP BY doc_id),
word AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t
  FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(g.n, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN gone_list g ON d.doc_id = g.doc_id LEFT JOIN kept k ON d.doc_id = k.doc_id
"""
