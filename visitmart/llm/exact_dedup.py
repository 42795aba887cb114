"""Exact dedup with two-pass Bloom filtering.

Texts are equal when identical after deleting every character of
``[\\x20\\x09-\\x0D]``; a null text counts as empty. Of equal texts the row with
the most code points, then the smallest id (nulls last), stays.

Pass 1 turns every row's text hash into a position key and builds, segment by
segment, two Bloom filters: "seen" and "seen again". Each task first merges its
own keys, so one text that makes up a third of the rows sends one entry per
batch. Pass 2 probes "seen again": rows that miss it cannot have an equal and
pass straight through; only hits shuffle and are grouped on the full SHA-256.
False positives therefore cost a little shuffle and never change the result.

The filter is bounded whatever the input: the hash space is cut into as many
rounds as keep one round's filter within ``max_filter_bytes``, and only one
round's filter is on the driver and the executors at a time.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

SPACES = " \t\n\x0b\x0c\r"
SEGMENT_BITS = 1 << 16


def normal_text(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), SPACES, "")


def _positions(keys: np.ndarray, k: int) -> np.ndarray:
    """k bit positions in a segment for each 64-bit key (double hashing)."""
    a, b = keys & np.uint64(0xFFFF), (keys >> np.uint64(16)) & np.uint64(0xFFFF) | np.uint64(1)
    return ((a[:, None] + b[:, None] * np.arange(k, dtype=np.uint64)) % np.uint64(SEGMENT_BITS)).astype(np.uint16)


def _segment(keys: np.ndarray, segments: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) % np.uint64(segments)).astype(np.int32)


def repeat_filter(hashes: DataFrame, n_rows: int, bits_per_key: int = 16, k: int = 4,
                  max_filter_bytes: int = 256 << 20):
    """The "seen again" filter of a one-column frame of 64-bit ``key`` values:
    a (segments, SEGMENT_BITS / 8) byte array. At most ``max_filter_bytes``.
    """
    segments = max(1, min(math.ceil(n_rows * bits_per_key / SEGMENT_BITS), max_filter_bytes * 8 // SEGMENT_BITS))

    def local(batches):
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            uniq, count = np.unique(keys, return_counts=True)
            seg = _segment(uniq, segments)
            order = np.argsort(seg, kind="stable")
            uniq, count, seg = uniq[order], count[order], seg[order]
            cut = np.flatnonzero(np.diff(seg)) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(seg[np.concatenate([[0], cut])] if len(seg) else seg, pa.int32()),
                 pa.array([x.tobytes() for x in np.split(uniq, cut)] if len(seg) else [], pa.binary()),
                 pa.array([(x > 1).tobytes() for x in np.split(count, cut)] if len(seg) else [], pa.binary())],
                names=["segment", "keys", "twice"])

    def merge(table: pa.Table) -> pa.Table:
        seen, again = np.zeros(SEGMENT_BITS, bool), np.zeros(SEGMENT_BITS, bool)
        for keys, twice in zip(table["keys"], table["twice"]):
            pos = _positions(np.frombuffer(keys.as_py(), np.uint64), k)
            dup = seen[pos].all(axis=1) | np.frombuffer(twice.as_py(), bool)
            # keys of one entry that collide in the filter count as seen again too
            flat = np.bincount(pos.ravel(), minlength=SEGMENT_BITS) > 1
            dup |= (flat[pos] | seen[pos]).all(axis=1)
            again[pos[dup].ravel()] = True
            seen[pos.ravel()] = True
        return pa.table({"segment": table["segment"][:1].cast(pa.int32()),
                         "bits": pa.array([np.packbits(again).tobytes()], pa.binary())})

    parts = (hashes.select("key").mapInArrow(local, "segment int, keys binary, twice binary")
             .groupBy("segment").applyInArrow(merge, "segment int, bits binary"))
    out = np.zeros((segments, SEGMENT_BITS // 8), np.uint8)
    for row in parts.toLocalIterator():          # at most max_filter_bytes in all
        out[row["segment"]] = np.frombuffer(row["bits"], np.uint8)
    return out


def probe(df: DataFrame, bits: np.ndarray, k: int = 4) -> DataFrame:
    """``df`` (with ``key``) plus ``_maybe``: may the key occur again?"""
    shared = df.sparkSession.sparkContext.broadcast(bits)

    @F.pandas_udf("boolean")
    def hit(key):
        import pandas as pd

        keys, f = key.to_numpy(np.int64).view(np.uint64), shared.value
        pos = _positions(keys, k)
        return pd.Series((f[_segment(keys, len(f))[:, None], pos >> 3] >> (7 - (pos & 7)) & 1).all(axis=1))

    return df.withColumn("_maybe", hit("key"))


def split_repeats(table: DataFrame, n_rows: int, bits_per_key: int, max_filter_bytes: int) -> DataFrame:
    """``table`` with ``_maybe``, one round of the hash space after another."""
    rounds = max(1, math.ceil(n_rows * bits_per_key / 8 / max_filter_bytes))
    out = None
    for r in range(rounds):
        mine = table if rounds == 1 else table.filter(
            F.pmod(F.shiftrightunsigned("key", 40), F.lit(rounds)) == r)
        bits = repeat_filter(mine.select("key"), max(1, n_rows // rounds), bits_per_key,
                             max_filter_bytes=max_filter_bytes)
        part = probe(mine, bits)
        if rounds > 1:                   # written, so that no round's filter is needed again
            part = materialize(part)
        out = part if out is None else out.unionByName(part)
    return out


def digests(df: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(_row, id, n_cp, sha, key) of every row, written once and read back."""
    sha = F.sha2(normal_text(F.col(text)).cast("binary"), 256)
    out = df.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).cast("long").alias("_id"),
                    F.char_length(F.coalesce(F.col(text), F.lit(""))).alias("n_cp"), F.unhex(sha).alias("sha"))
    return materialize(out.withColumn("key", _key(F.col("sha"))))


def _key(sha: Column) -> Column:
    return F.xxhash64(sha)


def exact_dedup(df: DataFrame, text: str = "text", id_col: str = "doc_id", bits_per_key: int = 16,
                max_filter_bytes: int = 256 << 20) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Null text: empty. Null id: sorts after all ids. Rows that repeat entirely
    form one group of which exactly one row is kept. An empty table gives no
    rows. Other columns of the input, whatever their names, are not read.
    """
    table = digests(df, text, id_col)
    split = split_repeats(table, table.count(), bits_per_key, max_filter_bytes)
    alone = split.filter(~F.col("_maybe"))
    maybe = split.filter("_maybe")
    best = F.max(F.struct("n_cp", F.col("_id").isNotNull().alias("has"), F.bitwise_not("_id").alias("neg"),
                          (-F.col("_row")).alias("neg_row")))
    groups = maybe.groupBy(F.col("sha").alias("g")).agg(F.count("*").alias("n"), best.alias("best"))
    # Written first: both sides of the join are then plain exchanges, and a hot text's rows can be split.
    joined = maybe.join(materialize(groups), F.col("sha") == F.col("g")).select(
        F.col("_id").alias("doc_id"), F.bitwise_not("best.neg").alias("keep_id"), F.col("n").alias("group_size"),
        (-F.col("best.neg_row") == F.col("_row")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))
    return joined.unionByName(alone.select(
        F.col("_id").alias("doc_id"), F.col("_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256")))


def dedup_rows(df: DataFrame, text: str = "text", id_col: str = "doc_id", bits_per_key: int = 16,
               max_filter_bytes: int = 256 << 20) -> DataFrame:
    """The rows that stay, with all their columns.

    Rows that miss the filter never leave their task; of the others, one whole
    row per text and task is sent on (partial maximum), so a hot text does not
    pile up. Equal rows in every column count as one text group like any other.
    """
    sha = F.unhex(F.sha2(normal_text(F.col(text)).cast("binary"), 256))
    keyed = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_r"), sha.alias("sha")) \
              .withColumn("key", _key(F.col("sha")))
    split = split_repeats(keyed, df.count(), bits_per_key, max_filter_bytes)
    ident = F.col(f"_r.`{id_col}`")
    order = F.struct(F.char_length(F.coalesce(F.col(f"_r.`{text}`"), F.lit(""))).alias("a"),
                     ident.isNotNull().alias("b"), (-ident).alias("c"))
    kept = split.filter("_maybe").groupBy("sha").agg(F.max_by("_r", order).alias("_r"))
    return split.filter(~F.col("_maybe")).select("_r.*").unionByName(kept.select("_r.*"))


def op1_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_cp,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
       row_number() OVER w = 1 AS kept, h AS text_sha256
FROM d WINDOW w AS (PARTITION BY h ORDER BY n_cp DESC, doc_id)
"""
