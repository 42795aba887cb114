import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from visitmart.llm import rangecoder as rc
from visitmart.llm import tokens as m


def blocks_of(data):
    out = []
    for b in data:
        out.append((rc.HEAD.unpack(b[:rc.HEAD.size]), b[rc.HEAD.size:]))
    return out


def round_trip(ids, vocab):
    b = blocks_of(rc.encode_blocks(ids, vocab))
    got = rc.decode_blocks(b, vocab)
    return np.concatenate(got) if got else np.zeros(0, np.uint32)


@pytest.fixture()
def small(monkeypatch):
    monkeypatch.setattr(rc, "LANES", 16)
    monkeypatch.setattr(rc, "STEPS", 40)
    monkeypatch.setattr(rc, "GROUP", 3)


@pytest.mark.parametrize("n", [0, 1, 2, 15, 16, 17, 639, 640, 641, 5000])
def test_lengths(small, n):
    ids = np.random.default_rng(n).integers(0, 300, n)
    assert (round_trip(ids, 300) == ids).all()


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(0, 49407), max_size=700), st.integers(1, 40))
def test_any_ids(values, repeat):
    ids = np.array(values * repeat, np.int64)[:20000]
    assert (round_trip(ids, 49408) == ids).all()


def test_kinds_of_streams():
    rng = np.random.default_rng(1)
    n = rc.LANES * rc.STEPS + 1000
    streams = {"one id": np.zeros(n, np.int64), "last id": np.full(n, 49407), "uniform": rng.integers(0, 49408, n),
               "period": np.tile([5, 9, 5, 11, 49000], n // 5), "skewed": np.minimum(rng.geometric(0.01, n), 49407)}
    bits = {}
    for name, ids in streams.items():
        data = rc.encode_blocks(ids, 49408)
        assert (np.concatenate(rc.decode_blocks(blocks_of(data), 49408)) == ids).all(), name
        bits[name] = 8 * sum(map(len, data)) / len(ids)
    assert bits["one id"] < 0.5 and bits["period"] < 0.8                   # predicted ids cost little
    p = np.bincount(streams["skewed"]) / n
    entropy = -(p[p > 0] * np.log2(p[p > 0])).sum()
    assert bits["skewed"] < entropy + 1.2 and bits["uniform"] < 17.5


def test_blocks_stand_alone_and_damage_is_found(small):
    ids = np.random.default_rng(3).integers(0, 50, 640 * 4 + 7)
    b = blocks_of(rc.encode_blocks(ids, 50))
    assert len(b) == 5
    assert (rc.decode_blocks([b[2]], 50)[0] == ids[1280:1920]).all()
    head, payload = b[1]
    with pytest.raises(ValueError):
        rc.decode_blocks([(head, payload[:-1] + bytes([payload[-1] ^ 1]))], 50)
    with pytest.raises(ValueError):
        rc.decode_blocks([((*head[:5], head[5] ^ 1), payload)], 50)
    with pytest.raises(ValueError):
        rc.encode_blocks(np.array([50]), 50)


TEXTS = ["", None, "Hello, World's  end\n\n12 345", "é É ﬁ Ⅳ   nbsp x  y", "<|endoftext|> a <|startoftext|>b", " \t\x0b\x0c\r\n", "x" * 5000,
         "ΑΣ ΑΣΑ Σ", "é ́a", "don't CAN'T we'll", "word " * 5000, "漢字 かな 😀😀 a\x00b a\x1cb"]


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(m.model_path())


def reference(tok, text):
    return tok.encode(text or "", add_special_tokens=False).ids + [1]


def test_words_in_turn_equal_whole_texts(tok):
    import pyarrow as pa
    from visitmart.llm.arrays import text_buffer

    t = m.WordTokenizer(m.model_path(), keep=60)                            # small: it is emptied on the way
    for _ in range(2):
        ids, counts = m.append_end(*t.encode(*text_buffer(pa.array(TEXTS, pa.string()))), 1)
        ends = np.cumsum(counts)
        assert [ids[a:z].tolist() for a, z in zip(ends - counts, ends)] == [reference(tok, x) for x in TEXTS]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.one_of(st.characters(min_codepoint=32, max_codepoint=0x180), st.characters(exclude_categories=["Cs"])), max_size=25), max_size=60))
def test_any_texts(texts):
    import pyarrow as pa
    from visitmart.llm.arrays import text_buffer

    t = m.tokenizer(m.model_path())
    ids, counts = m.append_end(*t.encode(*text_buffer(pa.array(texts, pa.string()))), 1)
    ends = np.cumsum(counts)
    assert [ids[a:z].tolist() for a, z in zip(ends - counts, ends)] == [reference(t.tok, x) for x in texts]


def test_the_library_sees_each_pre_token_once(tok):
    """Words that differ in case or signs share their pre-tokens."""
    import pyarrow as pa
    from visitmart.llm.arrays import text_buffer

    class Counting:
        def __init__(self, inner):
            self.inner, self.seen = inner, []

        def encode_batch_fast(self, texts, **kw):
            self.seen += [w for x in texts for w in x.split()]
            return self.inner.encode_batch_fast(texts, **kw)

    t = m.WordTokenizer(m.model_path())
    t.tok, t.plain = Counting(t.tok), Counting(t.plain)
    texts = ["aa bb aa, bb. Aa AA (bb)", "caf\u00e9 caf\u00e9, aa:bb x7aa", "bb, (caf\u00e9)."]
    ids, counts = m.append_end(*t.encode(*text_buffer(pa.array(texts))), 1)
    assert ids.tolist() == [i for x in texts for i in reference(tok, x)]
    assert sorted(t.plain.seen + t.tok.seen) == sorted(["aa", "bb", ",", ".", "(", ")", ":", "x", "7", ").", "caf\u00e9"])


def test_a_pattern_that_cuts_otherwise_is_followed(tok):
    import pyarrow as pa
    from visitmart.llm.arrays import text_buffer

    t = m.WordTokenizer(m.model_path())
    t.ends[:] = False                                                       # no id ends a pre-token: words go alone
    ids, _ = t.encode(*text_buffer(pa.array(["one, two don't one,"])))
    assert ids.tolist() == reference(tok, "one, two don't one,")[:-1]


def test_order_0_places_by_guide_equal_a_full_search():
    rng = np.random.default_rng(4)
    for blocks, vocab in ((1, 5), (2, 300), (3, 20000)):
        model = rc.Model(blocks, 4, vocab)
        for _ in range(3):
            model.pending.append(rng.integers(0, vocab, 4 * blocks) + model.base0)
            model.renew()
            q = rng.integers(0, model.flat[-1], 2000).astype(np.int32)
            in_block = np.isin(q, model.flat[vocab::vocab + 1], invert=True)   # the sums between blocks are no one's
            assert (model.find(q) == np.searchsorted(model.flat, q, "right") - 1)[in_block].all()


def test_real_texts(tok):
    """Word by word equals text by text on the test documents."""
    import pyarrow.parquet as pq
    from visitmart.llm.arrays import text_buffer

    texts = pq.read_table("/root/testdata/sf0.001/documents.parquet")["text"]
    ids, counts = m.append_end(*m.WordTokenizer(m.model_path()).encode(*text_buffer(texts)), 1)
    ends = np.cumsum(counts)
    assert [ids[a:z].tolist() for a, z in zip(ends - counts, ends)] == [reference(tok, x) for x in texts.to_pylist()]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 0) for r in rows], "doc_id long, text string, ids string, part int")


def check(spark, tok, rows, **kw):
    got = sorted((tuple(r) for r in m.token_files(frame(spark, rows), **kw).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == sorted((d for d, _ in rows), key=lambda d: (d is not None, d or 0))
    at = 0
    texts = {}
    for d, t in rows:
        texts.setdefault(d, []).append(reference(tok, t))
    for d, start, n, crc in got:
        assert start == at
        match = [x for x in texts[d] if len(x) == n and zlib.crc32(np.array(x, "<u4").tobytes()) == crc]
        assert match
        texts[d].remove(match[0])
        at += n
    assert not any(texts.values())


def test_files(spark, tok, small):
    rng = random.Random(2)
    rows = [(i * 7 - 20, t) for i, t in enumerate(TEXTS)] + [(i, "some words here " * rng.randint(0, 90)) for i in range(300, 380)]
    rows += [(5, "again"), (None, "null id"), (None, None), (300, rows[-80][1])]
    rng.shuffle(rows)
    check(spark, tok, rows)
    check(spark, tok, rows, file_bytes=4000)


def test_empty_table(spark):
    assert m.token_files(frame(spark, [])).collect() == []
