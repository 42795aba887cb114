import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from visitmart.llm import jaccard as m
from visitmart.llm.arrays import U64
from visitmart.llm.components import components

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= 80 * len(a | sets[j]):
                parent[find(i)] = find(j)
    best = {}
    for i, (d, _) in enumerate(rows):
        k = find(i)
        best[k] = d if best.get(k) is None else best[k] if d is None else min(best[k], d)
    return sorted(((d, len(sets[i]), best[find(i)]) for i, (d, _) in enumerate(rows)), key=str)


def corpus(seed):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(500)]
    line = rng.choices(vocab, k=12)
    rows = []
    for g in range(12):
        base = rng.choices(vocab, k=rng.choice([6, 9, 30, 120]))
        for _ in range(rng.randint(1, 8)):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(w) // 60) + 1)):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            if rng.random() < 0.4:
                w = line + w
            rows.append((len(rows), " ".join(w).upper() if rng.random() < 0.2 else "\n".join(w)))
    chain = rng.choices(vocab, k=60)                       # neighbours link, ends do not
    for k in range(12):
        rows.append((200 + k, " ".join(chain[k * 2:] + [f"t{i}" for i in range(k * 2)])))
    rows += [(300, "a"), (301, "A "), (302, "a b c d"), (303, "a b c d"), (304, "a b c e"), (305, None), (306, ""), (307, " \t"),
             (308, "x x x x x x x x x"), (309, "x x x x x"), (300, "a"), (None, "a"), (None, "only null"), (310, "deep " * 5000)]
    rng.shuffle(rows)
    return rows


def run(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "clash", 1, "n") for r in rows], "doc_id long, text string, cls string, n int, label string")
    return sorted(map(tuple, m.jaccard_components(df, **kw).collect()), key=str)


def test_brute_force(spark):
    rows = corpus(1)
    assert run(spark, rows) == brute(rows)


def test_split_groups_and_chunks(spark, monkeypatch):
    """Groups cut to two members: every later step has to put them together."""
    monkeypatch.setattr(m, "plan", lambda docs, text="text": (4, 2))
    rows = corpus(2)
    assert run(spark, rows, max_group=2) == brute(rows)


def test_empty(spark):
    assert run(spark, []) == []


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(35)] + [(100 + i, 101 + i) for i in range(40)] + [(7, 7)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent if find(x) != x}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_tree_against_all_pairs(seed):
    rng = np.random.default_rng(seed)
    sets = []
    for _ in range(12):
        base = rng.integers(1, 2**63, rng.integers(1, 80)).astype(U64)
        for _ in range(rng.integers(1, 9)):
            keep = base[rng.random(len(base)) > 0.06]
            sets.append(np.unique(np.concatenate([keep if len(keep) else base, rng.integers(1, 2**63, rng.integers(0, 4)).astype(U64)])))
    labels = [int(x) for x in rng.integers(0, 70, len(sets))]

    def closure(pairs):
        p = list(range(len(sets)))

        def find(x):
            while p[x] != x:
                x = p[x]
            return x

        for a, b in pairs:
            p[find(a)] = find(b)
        return [find(i) for i in range(len(sets))]

    same = [(i, labels.index(x)) for i, x in enumerate(labels)]
    every = [(i, j) for i in range(len(sets)) for j in range(i) if m.links(sets[i], sets[j])]
    for known, lab in (([], None), (same, labels)):
        got = m.Tree(sets, lab).join()
        assert all(m.links(sets[i], sets[j]) for i, j in got)
        a, b = closure(known + got), closure(known + every)
        assert [a.index(x) for x in a] == [b.index(x) for x in b]


@pytest.mark.parametrize("copies", [2, 20])
def test_tree_links_near_copies_of_long_documents(copies):
    """Over 255 shingles to a bit; 20 copies are more than a leaf."""
    rng = np.random.default_rng(4)
    base = np.unique(rng.integers(1, 2**63, 165_000).astype(U64) * U64(2))
    sets = [np.delete(base, rng.integers(0, len(base), 50)) for _ in range(copies)]
    assert all(len(s) > 160_000 for s in sets) and m.links(sets[0], sets[1])
    got = m.Tree(sets).join()
    assert len(got) == copies - 1 and all(m.links(sets[i], sets[j]) for i, j in got)


def test_candidate_bounds():
    """Linking sets share at least k of their first asked shingles."""
    rng = np.random.default_rng(5)
    for _ in range(300):
        base = np.unique(rng.integers(1, 2**63, rng.integers(1, 60)))
        a, b = (np.unique(np.concatenate([base[rng.random(len(base)) > 0.08], rng.integers(1, 2**63, rng.integers(0, 5))])) for _ in "ab")
        if len(a) and len(b) and m.links(a, b):
            for x, y in ((a, b), (b, a)):
                px, py = (s[:len(s) - m.need(len(s)) + m.depth(len(s))] for s in (x, y))
                rare = [s[np.argsort(s % 7, kind="stable")][:len(s) - m.depth(m.need(n)) + 1] for s, n in ((px, len(x)), (py, len(y)))]
                assert len(np.intersect1d(*rare))
                assert len(np.intersect1d(px, py)) >= m.depth(m.need(len(x)))


def test_sets_against_brute_force():
    texts = ["a b c d e f a b c d e f", "A b", None, "", "é É ß x y z", "a b c d e"]
    s = m.Sets(pa.array(texts), 5)
    assert s.n.tolist() == [len(shingles(t)) for t in texts]
    assert m.Sets(pa.array(["a  B c\td e"]), 5).key == m.Sets(pa.array(["A b c d E "]), 5).key


def test_int_ids_over_several_chunks(spark, monkeypatch):
    monkeypatch.setattr(m, "plan", lambda docs: (3, 2))
    text = "a b c d e f g h i j k l m n o p q r s t u v w x y z "
    rows = [(i, text * 3 + f"tail{i}") for i in range(6)] + [(9, "quite another text of more than five words")]
    for t in ("int", "long"):
        got = m.jaccard_components(spark.createDataFrame(rows, f"doc_id {t}, text string"))
        assert {r.doc_id: r.component_id for r in got.collect()} == {**dict.fromkeys(range(6), 0), 9: 9}, t


def test_memory_of_a_slice_of_sets(spark, monkeypatch):
    rng = random.Random(5)
    text = pa.array([" ".join(str(rng.randrange(10**6)) for _ in range(200)) for _ in range(2000)], pa.string())
    batch = pa.RecordBatch.from_arrays([pa.array(range(2000), pa.int64()), text, pa.array(range(2000), pa.int64())], names=["doc_id", "text", "t"])
    taken = []
    monkeypatch.setattr(m, "releasing", lambda run: taken.append(run) or run)
    m.class_rows(spark.createDataFrame([(1, "a")], "doc_id long, text string"), 5)
    tracemalloc.start()
    try:
        got = list(taken[0](iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sum(b.num_rows for b in got) == 2000 and sum(sum(b.column("n").to_pylist()) for b in got) == 2000 * 196
    assert peak < 20 * 10**6                                      # 37 MB in slices of 2 MB, 10 MB in those of 512 KB
