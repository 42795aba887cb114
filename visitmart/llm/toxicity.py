"""Toxicity scores from averaged subword embeddings and a linear softmax.

A text is the bag of its character n-grams (3 to 6 bytes, A-Z lowered, within a
word including one bounding blank), hashed to ``2**BITS`` rows of an embedding
table. Its vector is the average of the rows; a linear layer and a softmax give
the class. Table and layer are trained together (Adam, numpy), so a misspelling
never seen in training still shares most of its n-gram vectors with the word.

Since average and layer are linear, a trained model scores a text as the mean
of one number per n-gram: scoring is a lookup per byte, whole texts, no limit.

Training reads at most ``per_class`` labelled rows of each class (chosen by the
hash of their id); everything else covers all rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .arrays import ngrams, release, slices, text_buffer

BITS = 17
SIZES = (3, 4, 5, 6)


def features(raw: np.ndarray, offsets: np.ndarray):
    """Per row: distinct buckets and their counts."""
    for a, z in slices(offsets, 1 << 19):
        off = offsets[a:z + 1] - offsets[a]
        grams, starts = ngrams(raw[offsets[a]:offsets[z]], off, SIZES, BITS)
        ends = np.append(starts[1:], len(grams[0][0]))
        for s, e in zip(starts, ends):
            yield np.unique(np.concatenate([x[s:e][ok[s:e]] for x, ok in grams]), return_counts=True)


def train(rows: list, dim: int = 4, epochs: int = 14, batch: int = 64, rate: float = 0.05, seed: int = 3) -> dict:
    """rows: (label, buckets, counts). Returns the table, the layer and the bias."""
    rng = np.random.default_rng(seed)
    size = 1 << BITS
    table = rng.normal(0, 0.1, (dim, size)).astype(np.float32)
    layer = rng.normal(0, 0.5, (dim, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (table, layer, bias)]
    weights = [(c / max(1, c.sum())).astype(np.float32) for _, _, c in rows]
    step = 0
    for _ in range(epochs):
        for part in np.array_split(rng.permutation(len(rows)), max(1, len(rows) // batch)):
            label = np.array([rows[i][0] for i in part])
            idx = np.concatenate([rows[i][1] for i in part])
            weight = np.concatenate([weights[i] for i in part])
            owner = np.repeat(np.arange(len(part)), [len(rows[i][1]) for i in part])
            mean = np.stack([np.bincount(owner, weight * t[idx], len(part)) for t in table], 1).astype(np.float32)
            z = mean @ layer + bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(part)), label] -= 1
            p /= len(part)                                   # gradient of the loss in z; its two columns cancel
            share = np.bincount(idx, weight * p[owner, 1], size).astype(np.float32)
            grads = ((layer[:, 1] - layer[:, 0])[:, None] * share, mean.T @ p, p.sum(0))
            step += 1
            fast = rate * (1 - 0.99 ** step) ** 0.5 / (1 - 0.9 ** step)
            for x, g, (m1, m2) in zip((table, layer, bias), grads, state):
                m1 += 0.1 * (g - m1)
                m2 += 0.01 * (g * g - m2)
                x -= fast * m1 / (np.sqrt(m2) + 1e-8)
    return {"table": table, "layer": layer, "bias": bias}


def collapse(model: dict, log_odds: float) -> tuple[np.ndarray, float]:
    """One number per bucket and the bias, moved to the given prior log-odds."""
    diff = model["layer"][:, 1] - model["layer"][:, 0]
    return (diff @ model["table"]).astype(np.float32), float(model["bias"][1] - model["bias"][0] + log_odds)


def logits(values: np.ndarray, bias: float, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    out = np.full(len(offsets) - 1, bias)
    for a, z in slices(offsets, 1 << 18):
        off = offsets[a:z + 1] - offsets[a]
        grams, starts = ngrams(raw[offsets[a]:offsets[z]], off, SIZES, BITS)
        total = np.zeros(len(grams[0][0]))
        n = np.zeros(len(total), np.int32)
        for bucket, ok in grams:
            total += np.where(ok, values[bucket], 0)
            n += ok
        cnt = np.add.reduceat(n, starts)
        out[a:z] += np.add.reduceat(total, starts) / np.maximum(cnt, 1)
    return out


def held_out(id_col: Column) -> Column:
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 3000, **kw) -> tuple[np.ndarray, float]:
    """Train on at most ``per_class`` rows of each class outside the held-out fold.

    Without two classes to learn from, the model is the constant prior.
    """
    spark = docs.sparkSession
    use = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))) \
                .select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("_y"))
    counts = dict(use.groupBy("_y").count().collect())                  # at most two rows
    n0, n1 = counts.get(0, 0), counts.get(1, 0)
    prior = float(np.log((n1 + 1) / (n0 + 1)))
    if not n0 or not n1:
        return np.zeros(1 << BITS, np.float32), prior
    chosen = None
    for y in (0, 1):
        part = use.filter(F.col("_y") == y).orderBy(F.xxhash64("_id"), "_id").limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    rows = docs.select(F.col("doc_id"), F.col("text")).join(chosen, F.col("doc_id") == F.col("_id")).select("_y", "text")

    def featurise(batches):
        for batch in batches:
            raw, off = text_buffer(batch.column(1))
            f = list(features(raw, off))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([i.astype(np.int32).tobytes() for i, _ in f], pa.binary()),
                                              pa.array([c.astype(np.int32).tobytes() for _, c in f], pa.binary())],
                                             names=["y", "idx", "cnt"])

    feats = materialize(rows.mapInArrow(featurise, "y int, idx binary, cnt binary"))

    def learn(batches):
        data = [(y, np.frombuffer(i, np.int32), np.frombuffer(c, np.int32)) for b in batches
                for y, i, c in zip(*(b.column(k).to_pylist() for k in range(3)))]
        data.sort(key=lambda r: (r[0], len(r[1]), r[1].tobytes()))      # the same order in every run
        values, bias = collapse(train(data, **kw), 0.0)
        yield pa.RecordBatch.from_pydict({"values": pa.array([values.tobytes()], pa.binary()), "bias": [bias]})

    model = feats.repartition(1).mapInArrow(learn, "values binary, bias double").collect()[0]   # 0.5 MB
    m0, m1 = min(n0, per_class), min(n1, per_class)
    return np.frombuffer(model["values"], np.float32), model["bias"] + prior - float(np.log(m1 / m0))


def score(docs: DataFrame, model: tuple[np.ndarray, float]) -> DataFrame:
    """doc_id, held_out, score, predicted of every row. Null text: scored as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)             # fixed size: 2**BITS floats

    def run(batches):
        for batch in batches:
            raw, off = text_buffer(batch.column(1))
            z = np.clip(logits(*shared.value, raw, off), -60, 60)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-z)))], names=["doc_id", "score"])
            release()

    out = docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(run, "doc_id long, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
