import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from visitmart.llm import merkle as m

COLS = "doc_id long, text string, lang string, source string, n_chars long, leaf string, root string, part int, tree string, t long"


def digest(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    text = {"doc_id": row[0], "source": row[3], "lang": row[2], "n_chars": row[4], "text": row[1]}
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in text.values()))


def levels(leaves):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([digest(*out[-1][i:i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def climb(lv, i):
    """(sibling or None, is it on the left) at each level."""
    out = []
    for row in lv[:-1]:
        out.append((row[i ^ 1] if i ^ 1 < len(row) else None, i % 2 == 1))
        i //= 2
    return out


def brute(rows):
    trees = {}
    for r in rows:
        trees.setdefault(r[2], []).append(r)
    order = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    built = {}
    for lang in order:
        trees[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, bytes.fromhex(leaf_of(r))))
        built[lang] = levels([leaf_of(r) for r in trees[lang]])
    top = levels([built[x][-1][0] for x in order])
    out = []
    for t, lang in enumerate(order):
        for i, r in enumerate(trees[lang]):
            path = climb(built[lang], i) + climb(top, t)
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[4] is not None
            h = leaf_of(r[:4] + (r[4] + 1,)) if hit else leaf_of(r)
            for s, left in path:
                h = digest(*([h] if s is None else [s, h] if left else [h, s]))
            out.append((r[0], leaf_of(r), built[lang][-1][0], top[-1][0], digest(*(s for s, _ in path if s)), h, h == top[-1][0]))
    return sorted(out, key=str)


def run(spark, rows, **kw):
    docs = spark.createDataFrame([(*r, "x", "y", 1, "z", 9) for r in rows], COLS)
    hit = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0) & F.col("n_chars").isNotNull()
    got = m.manifest(docs, altered=(hit, {"n_chars": F.col("n_chars").cast("decimal(20,0)") + 1}), **kw)
    return sorted((tuple(r) for r in got.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=str)


def data():
    rows = [(i, f"text {i} é\n", ("en", "de", "en")[i % 3], "web" if i % 5 else None, None if i % 11 == 0 else i) for i in range(83)]
    rows += [(3, "again", "en", "web", 3), (3, "again", "en", "web", 3), (4, "", None, "", 2**63 - 1), (None, None, "en", None, None), (None, "x", None, "s", 1),
             (-5, "long " * 50_000, "ß", "s", 5), (7, "z", "", "s", 5), (14, "one", "z", "s", 1)]
    return rows


@pytest.mark.parametrize("kw", [{}, {"rows_per_part": 5, "stratum": 2}])
def test_brute_force(spark, kw):
    rows = data()
    assert run(spark, rows, **kw) == brute(rows)


def test_equal_rows_one_row_and_empty(spark):
    same = [(1, "a", "en", "s", 1)] * 9
    assert run(spark, same, rows_per_part=2, stratum=1) == brute(same)
    assert run(spark, same[:1]) == brute(same[:1])
    assert run(spark, []) == []


def test_proofs_lead_from_leaf_to_root_and_fail_when_bent(spark):
    docs = spark.createDataFrame([(i, str(i), "en", "s", 1) for i in range(21)], "doc_id long, text string, lang string, source string, n_chars long")
    for r in m.manifest(docs, with_proofs=True, rows_per_part=4).collect():
        raw, sib, i = [bytes(r.proof[k:k + 64]) for k in range(0, len(r.proof), 64)], [], r.position
        for level in range(m.height(r.tree_size)):
            sib.append(raw.pop(0) if (i ^ 1) < m.width(r.tree_size, level) else None)
            i >>= 1
        assert not raw and m.fold(r.leaf.encode(), r.position, sib).decode() == r.root == r.folded_root and r.verified
        assert m.fold(b"0" * 64, r.position, sib).decode() != r.root


@pytest.mark.parametrize("n", [1, 2, 3, 7, 8, 21])
def test_octopus_asks_for_what_is_not_derived(n):
    leaves = [str(i).encode() for i in range(n)]
    lv = [leaves]
    while len(lv[-1]) > 1:
        lv.append([m.parent(*lv[-1][i:i + 2]) for i in range(0, len(lv[-1]), 2)])
    for a in range(n):
        for z in range(a + 1, n + 1):
            need = m.missing(m.np.arange(a, z), n)
            assert len(need) <= 2 * m.height(n)
            paths = m.Paths({i: leaves[i] for i in range(a, z)}, {(k, i): lv[k][i] for k, i in need}, n)
            assert paths.root == lv[-1][0]
            known = {(k, i) for k, i, _ in m.published(leaves[a:z], a, n)}
            assert all(lv[k][i] == h for k, i, h in m.published(leaves[a:z], a, n)) and (a, z) != (0, n) or known == {(m.height(n), 0)}
