import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from visitmart.llm import exchange
from visitmart.llm import substrings as m

SCHEMA = "doc_id long, text string, chunk string, bucket int, n_words int"


def brute(rows, window):
    words = [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode()) for _, t in rows]
    ids = [float("inf") if d is None else d for d, _ in rows]
    least = {}
    for d, w in zip(ids, words):
        for i in range(len(w) - window + 1):
            k = tuple(w[i:i + window])
            least[k] = min(least.get(k, d), d)
    out = []
    for (d0, _), d, w in zip(rows, ids, words):
        gone = set()
        for i in range(len(w) - window + 1):
            if least[tuple(w[i:i + window])] < d:
                gone |= set(range(i, i + window))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d0, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, window=13, **kw):
    df = spark.createDataFrame([(*r, "clash", 1, 2) for r in rows], SCHEMA)
    got = m.remove_repeats(df, window).collect()
    for r in got:
        for (a, z), nxt in zip(r.repeats, r.repeats[1:] + [[10**9, 0]]):
            assert 0 <= a < z <= r.n_words and z < nxt[0] and z - a >= window
        assert sum(z - a for a, z in r.repeats) == r.n_removed
    return sorted(((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept_text.encode()).hexdigest()) for r in got), key=str)


def corpus(seed, n=60):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(200)] + ["é", "ü-ü"]
    passage = [rng.choices(vocab, k=rng.randint(8, 40)) for _ in range(6)]
    rows = []
    for i in range(n):
        w = []
        for _ in range(rng.randint(0, 5)):
            w += rng.choices(vocab, k=rng.randint(0, 15))
            p = rng.choice(passage)
            a = rng.randint(0, len(p) // 2)
            w += p[a:rng.randint(a, len(p))]
        rows.append((rng.choice([i, i, i, 3]), rng.choice([" ", "\n", "\t "]).join(w)))
    hot = " ".join(rng.choices(vocab, k=30))
    rows += [(1000 + i, f"{hot} own{i}" if i % 3 else f"x{i} y{i} {hot}") for i in range(40)]
    rows += [(1000, rows[-40][1]), (1001, rows[-38][1])]                       # repeated rows
    rows += [(None, hot), (None, None), (2000, None), (2001, ""), (2002, " \n"), (2003, " ".join(["same"] * 500)),
             (2004, " ".join(["same"] * 13)), (2005, " ".join(["same"] * 12)), (2006, "long " * 20000 + "z " + hot)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,window", [(1, 13), (2, 13), (3, 4)])
def test_brute_force(spark, monkeypatch, seed, window):
    monkeypatch.setattr(m, "plan", lambda docs, text="text": (5, 3))            # several chunks and buckets
    rows = corpus(seed)
    assert run(spark, rows, window) == brute(rows, window)


def test_one_chunk_and_empty(spark):
    rows = corpus(4, 20)
    assert run(spark, rows) == brute(rows, 13)
    assert run(spark, []) == []


def test_plan_grows_with_the_texts(spark):
    df = spark.createDataFrame([(i, "x" * 1000) for i in range(200)], "doc_id long, text string")
    assert exchange.plan(df) == (1, 1)
    chunks, buckets = exchange.plan(df, least=1000, most=2000)
    assert chunks >= 100 and 1 <= buckets <= chunks


def test_chunks_and_buckets_stay_small(spark):
    """1.2 GB in 120 rows, and 20 MB: the same bytes to a chunk and to a bucket, at most."""
    for rows, size in ((120, 10_000_000), (20, 1_000_000)):
        df = spark.range(rows).select(F.repeat(F.lit("x"), (F.col("id") * 0 + size).cast("int")).alias("text"))
        chunks, buckets = exchange.plan(df)
        assert rows * size / chunks <= 2 << 20 and rows * size / buckets <= 16 << 20


def test_texts_are_dealt_out_once(spark):
    df = spark.createDataFrame([(i, f"a b {i}") for i in range(50)], "doc_id long, text string")
    out = m.remove_repeats(df)
    out.collect()
    text = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert text.count("ReusedExchange") >= 2
