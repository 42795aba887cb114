import random
import re

import pytest
import xxhash

from visitmart.llm import simhash as m

COLS = "doc_id long, text string, fp long, key string, root int"


def plain(text, width=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda x: x[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << j for j in range(64) if 2 * sum(x >> j & 1 for x in h) > len(h))


def groups(fps, radius=2):
    """Least fingerprint (signed) reachable from each."""
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if ((a ^ b) & (2**64 - 1)).bit_count() <= radius:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {f: find(f) for f in fps}


def signed(x):
    return x - 2**64 if x >> 63 else x


def clusters(seed=1):
    """Chains and balls of fingerprints, some around one centre, so that entries fill up."""
    r = random.Random(seed)
    out = {0, 2**64 - 1, 1 << 63, (1 << 63) | 1 << 31}
    for k in range(12):
        base = r.getrandbits(64)
        for _ in range(40 if k else 150):
            x = base
            for b in r.sample(range(64) if k % 3 else range(0, 64, 5), r.randint(0, 4)):
                x ^= 1 << b
            out.add(x)
            if r.random() < 0.2:
                base = x
    return sorted(signed(x) for x in out)


@pytest.mark.parametrize("kw", [{"radius": 2}, {"radius": 2, "max_run": 3, "bucket_rows": 300}, {"radius": 1, "max_run": 3}, {"radius": 3, "max_run": 20}])
def test_links_against_all_pairs(spark, kw):
    fps = clusters()
    got = dict(tuple(x) for x in m.linked(spark.createDataFrame([(f,) for f in fps], "fp long"), **kw).collect())
    assert {f: got.get(f, f) for f in fps} == groups(fps, kw["radius"])


def test_balls_find_every_pair_within_the_radius():
    for radius in range(4):
        for x in (x for x in range(256) if x.bit_count() <= radius):
            assert any((part & 15).bit_count() <= r for part, r in zip((x, x >> 4), m.balls(radius))), (radius, x)


def test_a_full_entry_reports_few_links():
    base = 0x0123456789ABCDEF
    fps = [base ^ 1 << a ^ 1 << b for a in range(64) for b in range(a)]
    table = m.pa.table({"key": [7] * len(fps), "fp": m.np.array(fps, m.np.uint64).view(m.np.int64), "home": [True] * len(fps)})
    assert m.verified(2, most=1000)(table).num_rows == len(fps) - 1


def texts():
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdeéß") for _ in range(r.randint(1, 9)))
    base = [word() for _ in range(400)]
    out = [None, "", " \t\n\x0b\x0c\r", "One", "one  TWO", "One\ttwo three", "É é É", "nul\x00 a\x1fb c d", "x" * 3000 + " y z"]
    for k in range(60):
        near = list(base)
        for _ in range(k % 4):
            near[r.randrange(400)] = word()
        out.append(" ".join(near))
    return out + [" ".join(word() for _ in range(r.randint(1, 40))) for _ in range(60)] + [" ".join(base)] * 5


def test_brute_force(spark):
    rows = [(i, t) for i, t in enumerate(texts())] + [(None, "One"), (None, "alone at last"), (3, "One"), (-7, "one")]
    docs = spark.createDataFrame([(*x, 1, "k", 2) for x in rows], COLS)
    fp = [signed(plain(t)) for _, t in rows]
    root = groups(sorted(set(fp)))
    least = {}
    for (i, _), f in zip(rows, fp):
        if i is not None:
            least[root[f]] = min(i, least.get(root[f], i))
    want = sorted(((i, f"{f & (2**64 - 1):016x}", least.get(root[f])) for (i, _), f in zip(rows, fp)), key=str)
    for kw in ({}, {"max_run": 2, "bucket_rows": 50}):
        got = m.simhash_components(docs, **kw)
        assert got.columns == ["doc_id", "fingerprint", "component_id"]
        assert sorted(map(tuple, got.collect()), key=str) == want
    assert m.simhash_components(docs.limit(0)).collect() == []


def test_long_texts_in_pieces():
    for t in texts():
        assert m.fingerprint(t, piece=7) == m.fingerprint(t) == plain(t)
    long = "Ab cd  efg\n" * 100_000 + "y" * 3_000_000
    assert m.fingerprint(long) == m.fingerprint(long, piece=1 << 30)
