import hashlib
import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from visitmart.llm import pieces as m
from visitmart.llm.arrays import U64, text_buffer

TEXTS = ["", None, "a", " ", "  ", "The quick  brown fox\njumped.\n\n over", " lead", "trail  ", "é漢😀 ▁literal▁ mark", "\t\r\x0b\x0c",
         "x" * 300, "naïve Straße übermorgen", "a\x00b", "word " * 3000, "supercalifragilisticexpialidocious " * 3, "The quick  brown fox"]


def encode(texts, **kw):
    raw, off = text_buffer(pa.array(texts, pa.string()))
    ids, n = m.Encoder(**kw).encode(raw, off, np.arange(len(texts)).astype(U64))
    ends = np.cumsum(n)
    return ids, n, [ids[a:z].tolist() for a, z in zip(ends - n, ends)]


@pytest.fixture(scope="module")
def sp():
    return sentencepiece.SentencePieceProcessor(model_file=m.model_path())


def test_without_dropout_equals_the_library(sp):
    texts = [t for t in TEXTS if t is not None and m.MARK not in t]
    assert encode(texts, rate=0)[2] == [sp.encode(t) for t in texts]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=40), min_size=1, max_size=6), st.sampled_from([0, 0.1, 0.5, 1]))
def test_lossless(texts, rate):
    ids, n, _ = encode(texts, rate=rate, seed=4)
    assert [x.decode() for x in m.Decoder().decode(ids, n)] == texts


def test_heap_and_matrix_agree():
    v = m.Pieces(m.model_path())
    words = ["internationalisation", "unbelievable", "aaaaaaaaaaaa", "the", "straightforwardness", "xqzjk"] * 5
    for rate in (0.0, 0.1, 0.6):
        sym = [[int(v.symbol_of[ord(c)]) for c in " " + w] for w in words]
        length = np.array([len(s) for s in sym])
        key = m.mix64(np.arange(len(words)).astype(U64))
        flat, size = m.merge_units(v, np.concatenate(sym), length, key, rate)
        ends = np.cumsum(size)
        assert [flat[a:z].tolist() for a, z in zip(ends - size, ends)] == [
            m.merge_heap(v, s, int(k), rate) for s, k in zip(sym, key)]


def test_seeded_and_varied():
    texts = ["international understanding of straightforward reasoning " * 20] * 3
    a, b, c = (encode(texts, rate=0.3, seed=s)[2] for s in (1, 1, 2))
    assert a == b and a != c
    assert a[0] != a[1]                                 # the same text in two documents
    none, full = encode(texts, rate=0)[1].sum(), encode(texts, rate=1)[1].sum()
    assert none < sum(map(len, a)) < full


def test_every_occurrence_is_drawn_for_itself():
    ids, _, _ = encode([" ".join(["understanding"] * 400)] * 5, rate=0.3)
    end, at, ways = np.cumsum(m.Decoder().len[ids]), 0, set()
    for k in np.flatnonzero(end % 14 == 0) + 1:              # a word and the blank before it are 14 bytes
        ways.add(tuple(ids[at:k].tolist()))
        at = k
    assert len(ways) > 40


def test_copies_of_a_row_differ(spark):
    rows = [(1, "international understanding of straightforward reasoning " * 20)] * 3 + [(2, "once"), (None, None), (None, None), (None, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got, again = (sorted(((r.key, r.text_sha256, r.ids) for r in m.encode_texts(x, rate=0.3).collect()), key=str)
                  for x in (df, df.repartition(3, "text").union(df.limit(0))))
    assert got == again and len(got) == len(rows)
    assert len({tuple(ids) for key, _, ids in got if key == 1}) == 3
    assert all(r.lossless for r in m.round_trip(df).collect())


def frame(spark):
    return spark.createDataFrame([(i, t, "clash", 0) for i, t in enumerate(TEXTS)] + [(0, "", "x", 1), (None, "null id", None, None)],
                                 "doc_id long, text string, ids string, key int")


def test_round_trip(spark):
    got = {(r.doc_id, r.text_sha256): r for r in m.round_trip(frame(spark)).collect()}
    for i, t in [*enumerate(TEXTS), (None, "null id")]:
        r = got[i, hashlib.sha256((t or "").encode()).hexdigest()]
        assert r.lossless and (r.n_pieces == 0) == (not t)
    enc = {r.key: r.ids for r in m.encode_texts(frame(spark)).collect()}
    for i, t in enumerate(TEXTS):
        r = got[i, hashlib.sha256((t or "").encode()).hexdigest()]
        assert r.n_pieces == len(enc[i]) and r.ids_crc32 == zlib.crc32(np.array(enc[i], "<i4").tobytes())
    assert len(m.round_trip(frame(spark)).collect()) == len(TEXTS) + 2


def test_decoded_texts_and_empty_table(spark):
    got = {r.key: r.text for r in m.decode_ids(m.encode_texts(frame(spark), rate=0.4)).collect()}
    assert got == {i: t or "" for i, t in enumerate(TEXTS)} | {None: "null id"}
    assert m.round_trip(frame(spark).limit(0)).collect() == []


def long_batch(n=2000):
    rng = random.Random(3)
    texts = [" ".join("".join(rng.choices("etaoinshrdlu", k=rng.randint(1, 9))) for _ in range(rng.randint(0, 400))) for _ in range(n)]
    return pa.RecordBatch.from_arrays([pa.array(range(n), pa.int64()), pa.array(texts, pa.string()), pa.array(range(n), pa.int64())],
                                      names=["key", "text", "h"])


def test_memory_of_a_slice():
    batch = long_batch()
    assert batch.column(1).nbytes > 2 * 10**6
    m.vocabulary(m.model_path())
    tracemalloc.start()
    try:
        rows = sum(b.num_rows for b in m.encoded_batches([batch], m.model_path(), 0.1, 1))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows == batch.num_rows and peak < 60 * 10**6           # 96 MB in slices of 2 MB, 28 MB in those of 512 KB


def test_slices_do_not_change_the_ids(monkeypatch):
    def ids():
        return [x for b in m.encoded_batches([long_batch(300)], m.model_path(), 0.2, 1) for x in b.column("ids").to_pylist()]

    whole = ids()
    monkeypatch.setattr(m, "SLICE", 1 << 12)
    assert ids() == whole


def test_round_trip_takes_one_worker_a_task(spark):
    rows = [(1, "twice"), (1, "twice"), (2, "once")]
    for df in (spark.createDataFrame(rows, "doc_id long, text string"), frame(spark)):
        plan = m.round_trip(df)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("MapInArrow") == 1                      # decoding in a second map doubled the Python workers
