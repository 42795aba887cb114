import math
import re
from collections import Counter

import numpy as np
import pytest

from visitmart.llm import lexical as m

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
COLS = "doc_id long, text string, item_id long, n long, terms string, tf int, task int"


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda x: x[0].lower(), text or ""))


def brute(docs, items, k=20):
    bags = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n_docs, n_terms = len(bags), sum(b.total() for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in {(i, t) for i, t in items}:
        scores = []
        for d, b in bags:
            mm = 100 - 25 + (25 * b.total() * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * b[t] // (1000 * b[t] + 12 * mm))
                    for t in terms(text) if b[t])
            if s > 0:
                scores.append((-s, d is None, d or 0, d))
        out += [(item, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scores, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=str)


def tables():
    words = ["ab", "Ab", "é", "É", "x1", "日本", "fox", "dog", "the", "the", "the", "q\u0080z", "ÅNGSTRÖM"]
    rng = np.random.RandomState(3)
    docs = [(i, " ,;\x7f\n"[rng.randint(5)].join(words[j] for j in rng.randint(0, len(words), rng.randint(1, 30)))) for i in range(150)]
    docs += [(200, None), (201, ""), (202, " .,!\x00"), (203, "fox " * 5000), (None, "fox dog"), (None, "fox dog"), (5, "fox dog"), (-4, "fox dog")]
    items = [(1, "the FOX"), (1, "the FOX"), (1, "dog"), (2, None), (3, " . "), (4, "unknown"), (5, "fox fox fox dog"), (6, "é É q\u0080z ångström"), (7, " ".join(words * 40))]
    return docs, items


@pytest.mark.parametrize("kw", [{}, {"k": 3, "items_per_tile": 2, "columns": 2, "docs_per_tile": 7, "block_bytes": 100}])
def test_brute_force(spark, kw):
    docs, items = tables()
    got = m.search(spark.createDataFrame([(*d, 1, 2, "x", 3, 4) for d in docs], COLS).repartition(5),
                   spark.createDataFrame([(t, i, 9, 8) for i, t in items], "text string, item_id long, doc_id long, tf long"), **kw)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, items, kw.get("k", 20))


def test_empty_tables(spark):
    docs, items = (spark.createDataFrame(x, c) for x, c in zip(tables(), ("doc_id long, text string", "item_id long, text string")))
    for a, b in ((docs.limit(0), items), (docs, items.limit(0)), (docs.filter("doc_id in (200, 201, 202)"), items), (docs, items.filter("item_id = 3"))):
        assert m.search(a, b).collect() == []


def test_long_texts_in_pieces():
    for text in ["Fox é日 dog" * 50, "x" * 500, ",,,", "fox," * 300]:
        want = Counter(t.encode() for t in terms(text))
        assert m.terms(text, piece=7) == m.terms(text) == want


def test_products_stay_exact_where_repeats_exceed_the_bound():
    tile = m.ItemTile([(0, {0: 10**9, 1: 3}), (1, {1: 7})], np.array([9000, 41], np.int64), columns=4)
    row, term = np.array([0, 0, 1]), np.array([0, 1, 1])
    impact = np.array([999_999, 333_333, 1], np.int64)
    want = [[10**9 * 9000 * 999_999 + 3 * 41 * 333_333, 3 * 41], [7 * 41 * 333_333, 7 * 41]]
    assert tile.scores(row, term, impact, 2, 2).tolist() == want
    bound = m.EXACT // m.TOP_IMPACT
    small = m.ItemTile([(0, {0: 4 * bound // 9000, 1: 3})], np.array([9000, 41], np.int64), columns=4)
    assert len(small.tiles) > 3 and all((x.sum(1) * m.TOP_IMPACT <= m.EXACT).all() for _, x in small.tiles)
    assert small.scores(row, term, impact, 2, 2).tolist() == [[4 * bound // 9000 * 9000 * 999_999 + 123 * 333_333, 123]]


def test_ties_keep_the_smaller_id():
    best = m.Best(1, 2)
    for ids in ([9, 8], [7, 8], [1, 9]):
        best.add(0, np.array([[5, 5]]), np.array(ids), np.array([False, False]))
    assert best.id.tolist() == [1, 7] and best.score.tolist() == [5, 5]
