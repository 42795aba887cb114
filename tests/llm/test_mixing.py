import hashlib
import math
import re
from collections import Counter, defaultdict

from visitmart.llm import mixing as m

SCHEMA = "doc_id long, text string, source string, size int, copies string"


def docs(spark, rows):
    return spark.createDataFrame([(a, t, s, 5, "clash") for a, t, s in rows], SCHEMA)


def brute_targets(sizes):
    """Share by weight; stop at three times; share the excess again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, open_, left = {}, set(names), float(sum(sizes.values()))
    while open_:
        total = sum(w[s] for s in open_)
        over = {s for s in open_ if left * w[s] / total >= 3 * sizes[s]}
        if not over:
            return target | {s: left * w[s] / total for s in open_}
        for s in over:
            target[s] = 3 * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def h(x):
    return int(hashlib.md5(x.encode()).hexdigest()[:15], 16)


def brute(rows, seed=17):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    cls = lambda n: n if n < 8 else n.bit_length() * 4 + (n >> (n.bit_length() - 3) & 3)
    by = defaultdict(list)
    for a, t, s in rows:
        by[s].append((cls(size(t)), h(f"{seed}:{'' if a is None else a}"), a or -1, size(t), a))
    sizes = {s: sum(x[3] for x in v) for s, v in by.items()}
    targets, out = brute_targets(sizes), []
    for s, v in by.items():
        rate = targets[s] / sizes[s] if sizes[s] else 0
        u = h(f"{seed}:source:" + ("=" + s if s is not None else "")) % 2**20 / 2**20
        for k, x in enumerate(sorted(v), 1):
            out.append((x[4], x[3], math.floor(rate * k + u) - math.floor(rate * (k - 1) + u)))
    return targets, Counter(out)


ROWS = ([(i, "w " * (i % 40), "big") for i in range(300)] + [(1000 + i, "a b c\td", "mid") for i in range(30)]
        + [(2000 + i, " x ", None) for i in range(5)] + [(3000, "one two", ""), (3000, "one two", ""),
                                                         (None, None, "mid"), (4000, "", "zero")])


def test_brute_force(spark):
    targets, want = brute(ROWS)
    got = m.mix(docs(spark, ROWS)).collect()
    assert Counter((r._r.doc_id, r._size, r._copies) for r in got) == want
    for r in got:
        assert math.isclose(r._target, targets[r._r.source], rel_tol=1e-9, abs_tol=1e-9)
    assert math.isclose(sum(targets.values()), sum(r._size for r in got))


def test_cells_do_not_change_the_rank_sizes(spark):
    rows = [(i, "w " * (1 + i % 9), "a" if i % 3 else "b") for i in range(600)]
    got = m.mix(docs(spark, rows), rows_per_cell=50).collect()
    taken, target = Counter(), {}
    for r in got:
        assert 0 <= r._copies <= 3
        taken[r._r.source] += r._copies * r._size
        target[r._r.source] = r._target
    for s in target:
        assert abs(taken[s] - target[s]) <= 0.05 * target[s] + 9


def test_rows_and_reruns(spark):
    d = docs(spark, ROWS)
    a, b = ([tuple(r) for r in m.mixed_rows(d).collect()] for _ in range(2))
    assert m.mixed_rows(d).columns == d.columns
    assert Counter(a) == Counter(b)


def test_word_count(spark):
    texts = ["", None, " a ", "a\x0bb\x0c c", "\n\n", "a\xa0b", "x" * 100000 + " y"]
    rows = [(i, t, "s") for i, t in enumerate(texts)]
    got = [r[0] for r in docs(spark, rows).orderBy("doc_id").select(m.word_count(m.F.col("text"))).collect()]
    assert got == [0, 0, 1, 3, 0, 1, 2]


def test_empty(spark):
    assert m.mix(docs(spark, [])).collect() == []


def test_input_order_does_not_change_rows_of_null_or_equal_ids(spark):
    rows = [(i, " ".join(["w"] * n) + t, "s") for i in (None, 7) for n in (8, 9) for t in [""] + [f" x{k}" for k in range(12)]]
    rows += [(1, "big " * 40, "t")]
    schema = "doc_id long, text string, source string, m map<string,int>, `a.b` string"
    seen = []
    for order in (rows, rows[::-1], rows[1::2] + rows[::2]):
        df = spark.createDataFrame([(*r, {"k": 1}, "z") for r in order], schema).repartition(3)
        seen.append(sorted(map(str, ((r.doc_id, r.text) for r in m.mixed_rows(df).collect()))))
    assert seen[0] == seen[1] == seen[2] and seen[0]
