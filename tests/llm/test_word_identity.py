"""Words that a polynomial hash modulo 2**64 cannot tell apart (Thue-Morse words)."""

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from visitmart.llm import arrays, jaccard, substrings, tokens
from visitmart.llm.arrays import span_hashes, text_buffer


def twins(n: int) -> tuple[str, str]:
    """The Thue-Morse word of n letters and its complement."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


@pytest.mark.parametrize("n", [1024, 2048, 4096])
def test_token_ids_of_built_words_equal_the_library(n):
    a, b = twins(n)
    texts = [f"{a} {b}", b, a, f"x {b}, y", f"{a}1{b}'s <{a}>", "", "IT's İx \xd7 caf\xe9 A1b2--c"]
    lib = Tokenizer.from_file(tokens.model_path())
    ids, counts = tokens.WordTokenizer(tokens.model_path()).encode(*text_buffer(pa.array(texts)))
    want = [lib.encode(t, add_special_tokens=False).ids for t in texts]
    assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_words_that_share_the_first_hash_are_told_apart(monkeypatch):
    real = arrays.span_hashes
    monkeypatch.setattr(arrays, "span_hashes",
                        lambda raw, s, e, seed=0: real(raw, s, e, seed) % np.uint64(3) if seed == 0 else real(raw, s, e, seed))
    texts = ["one two three four five", "five four 6 x-y two", "one two three"]
    lib = Tokenizer.from_file(tokens.model_path())
    tok = tokens.WordTokenizer(tokens.model_path())
    for part in (texts[:1], texts[1:]):                     # the second slice meets the first one's words
        ids, _ = tok.encode(*text_buffer(pa.array(part)))
        assert ids.tolist() == [i for t in part for i in lib.encode(t, add_special_tokens=False).ids]


def test_span_hashes_do_not_depend_on_place_or_block():
    rng = np.random.RandomState(3)
    raw = rng.randint(97, 99, 5000).astype(np.uint8)
    start = np.sort(rng.choice(4900, 600, replace=False))
    end = start + rng.randint(0, 90, 600)
    got = span_hashes(raw, start, end)
    assert (got == span_hashes(raw, start, end, block=7)).all()
    alone = [span_hashes(raw[a:z], np.array([0]), np.array([z - a]))[0] for a, z in zip(start, end)]
    assert got.tolist() == [int(x) for x in alone]
    by_text = {}
    for a, z, h in zip(start, end, got):
        by_text.setdefault(bytes(raw[a:z]), set()).add(int(h))
    assert all(len(h) == 1 for h in by_text.values())
    assert len({h for x in by_text.values() for h in x}) == len(by_text)


def test_built_words_in_windows_and_shingles(spark):
    a, b = twins(1024)
    rest = " ".join(f"w{i}" for i in range(12))
    docs = spark.createDataFrame([(1, f"{a} {rest}"), (2, f"{b} {rest}"), (3, a), (4, b), (5, a)], "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in substrings.remove_repeats(docs).collect()} == {1: 0, 2: 0, 3: 0, 4: 0, 5: 0}
    assert {r.doc_id: r.component_id for r in jaccard.jaccard_components(docs).collect()} == {1: 1, 2: 1, 3: 3, 4: 4, 5: 3}
