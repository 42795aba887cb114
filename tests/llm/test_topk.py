import math

import numpy as np
import pytest

from visitmart.llm import topk as m

NAN, INF = float("nan"), float("inf")


def brute(rows, k=5, is_query=lambda i: i % 50 == 0):
    ok = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v):
            ok.setdefault((i, tuple(math.floor(256 * x) for x in v)), None)
    out = []
    for i, q in ok:
        if is_query(i):
            s = sorted({(-sum(a * b for a, b in zip(q, v)), j) for j, v in ok if j != i and len(v) == len(q)})
            out += [(i, r, j, -t) for r, (t, j) in enumerate(s[:k], 1)]
    return sorted(out)


def data(seed=1, n=700, dim=6):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in np.float32(rng.normal(size=dim))]) for i in range(n)]
    same = [0.5] * dim
    rows = [(i, same) if i % 3 == 0 else (i, v) for i, v in rows]           # a third are one vector
    return rows + [(900, None), (950, [1.0, None] + [0.0] * (dim - 2)), (1000, [NAN] * dim), (1050, [INF] + [0.0] * (dim - 1)), (1100, []),
                   (1150, [1.0, 2.0]), (1151, [2.0, 1.0]), (1200, [1.0]), (None, same), (50, rows[50][1]), (-100, [-0.001] * dim)]


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, 0, "clash", 1) for i, v in rows], "vec_id long, embedding array<float>, score int, shard string, rank int")
    return sorted(tuple(r) for r in m.top_k(df, is_query=lambda c: c % 50 == 0, **kw).collect())


@pytest.mark.parametrize("kw", [{}, {"rows_per_shard": 90, "block": 4}])
def test_brute_force(spark, kw):
    rows = data()
    assert run(spark, rows, **kw) == brute(rows)


def test_fewer_candidates_than_k_and_empty(spark):
    assert run(spark, [(50, [1.0, 1.0]), (1, [2.0, 0.0])]) == [(50, 1, 1, 131072)]
    assert run(spark, [(50, [1.0])]) == []
    assert run(spark, []) == []


def test_tree_visits_few_leaves_of_spread_clusters():
    """Bounds prune: a query near a far cluster reads a small part of the tree."""
    rng = np.random.default_rng(2)
    centre = rng.integers(-2000, 2000, (40, 4))
    v = np.concatenate([c + rng.integers(-10, 10, (100, 4)) for c in centre]).astype(np.int64)
    tree = m.build_shard(np.arange(len(v)), v, 5)
    tree = m.KDTree(tree.vectors, tree.ids, leaf=16)
    read = []

    class Spy(np.ndarray):
        def __getitem__(self, key):
            read.append(key)
            return super().__getitem__(key)

    tree.vectors = tree.vectors.view(Spy)
    q = centre[3] * 2
    got = tree.search(q, 5, -1)
    scores = v @ q
    assert got == [(int(scores[i]), int(i)) for i in np.lexsort((np.arange(len(v)), -scores))[:5]]
    assert len(read) < 0.2 * len(v) / 16


def test_tree_against_brute_force_with_ties():
    rng = np.random.default_rng(3)
    v = rng.integers(-2, 3, (500, 3)).astype(np.int64)
    ids = rng.permutation(500)
    tree = m.build_shard(ids, v, 4)
    tree = m.KDTree(tree.vectors, tree.ids, leaf=4)
    for q, own in zip(v[:60], ids[:60]):
        want = sorted((-int(a @ q), int(i)) for a, i in zip(v, ids) if i != own)[:4]
        for floor in (None, -want[-1][0]):
            assert tree.search(q, 4, int(own), floor) == [(-s, i) for s, i in want]


@pytest.mark.parametrize("x", [1e300, -1e300, 3e5])
def test_components_beyond_the_range_are_an_error_and_no_wrong_score(spark, x):
    table = spark.createDataFrame([(0, [1.0, x]), (1, [1.0, 2.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="scaled component"):
        m.quantised(table, "vec_id", "embedding", 256).collect()
