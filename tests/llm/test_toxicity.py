import random
import zlib

import numpy as np
import pyarrow as pa

from visitmart.llm import toxicity as m
from visitmart.llm.arrays import GRAM, GRAM_OF, text_buffer

NICE = "the cat sat on a warm mat and looked over green hills while rain fell softly on old roofs".split()
BAD = ["stupid", "worthless", "disgusting"]


def texts(n, seed=1):
    rng, out = random.Random(seed), []
    for i in range(n):
        words = [rng.choice(NICE) for _ in range(rng.randint(5, 60))]
        if i % 4 == 0:
            words[rng.randrange(len(words))] = rng.choice(BAD)
        out.append((i, " ".join(words), int(i % 4 == 0)))
    return out


def brute_buckets(text):
    """Buckets of all n-grams of a text, one by one."""
    data = b" " + bytes(b + 32 if 65 <= b <= 90 else 32 if b in (9, 10, 11, 12, 13) else b for b in text.encode()) + b" " * 12
    out = []
    for i in range(len(text.encode()) + 1):
        for n in m.SIZES:
            g = data[i:i + n]
            if b" " in g[1:n - 1] or g[:2] == b"  ":
                continue
            out.append(((int.from_bytes(g, "little") ^ GRAM_OF[n]) * GRAM % 2**64) >> (64 - m.BITS))
    return sorted(out)


def test_ngrams_against_brute_force():
    rows = ["Ab cde", "", "x", None, "é\tbcdefgh  Z", "aaaa aaaa"]
    raw, off = text_buffer(pa.array(rows, pa.string()))
    got = [sorted(np.repeat(i, c).tolist()) for i, c in m.features(raw, off)]
    assert got == [brute_buckets(r or "") for r in rows]


def tables(spark, data):
    docs = spark.createDataFrame([(i, t, "x", 1.0, 0) for i, t, _ in data], "doc_id long, text string, lang string, score double, toxic int")
    labels = spark.createDataFrame([(i, 0, y, "c") for i, _, y in data], "doc_id long, quality int, toxic int, text string")
    return docs, labels


def test_learns_and_scores_misspellings(spark):
    docs, labels = tables(spark, texts(400))
    model = m.fit(docs, labels, epochs=20)
    got = {r.doc_id: r for r in m.score(docs, model).collect()}
    held = [(i, y) for i, _, y in texts(400) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, _, _ in texts(400))
    assert sum(got[i].predicted == y for i, y in held) >= 0.9 * len(held)
    new = spark.createDataFrame([(1, "you are stupidd and worthles"), (2, "the cat sat softly on old hills"), (3, None), (4, ""),
                                 (5, "cat " * 200000)], "doc_id long, text string")
    s = {r.doc_id: r.score for r in m.score(new, model).collect()}
    assert s[1] > 0.5 > s[2] and s[3] == s[4] and s[5] < 0.5 and all(0 <= x <= 1 for x in s.values())


def test_fit_is_the_same_twice_and_bounded(spark):
    docs, labels = tables(spark, texts(80))
    a, b = (m.fit(docs, labels, per_class=10, epochs=2) for _ in range(2))
    assert a[1] == b[1] and (a[0] == b[0]).all()


def test_without_labels(spark):
    docs, labels = tables(spark, texts(8))
    out = m.score(docs, m.fit(docs, labels.filter("toxic = 0"))).collect()
    assert len(out) == 8 and {r.predicted for r in out} == {0}
    assert m.score(docs.limit(0), m.fit(docs, labels.limit(0))).collect() == []
