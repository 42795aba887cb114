import hashlib
import re
from collections import defaultdict

from visitmart.llm import exact_dedup as m

ROWS = [(1, "a b", "x"), (2, "ab", "x"), (3, None, None), (4, "", "y"), (5, "\t\n", None), (6, "zz", "x"),
        (6, "zz", "x"), (7, " ", None), (8, "q" * 30000, None), (9, "q" * 30000 + "\x0b", None), (None, "ab  ", "n")]


def brute(rows):
    groups = defaultdict(list)
    for i, (a, t, _) in enumerate(rows):
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), a is None, a or 0, i, a))
    out = []
    for text, g in groups.items():
        g.sort()
        out += [(x[4], g[0][4], len(g), j == 0, hashlib.sha256(text.encode()).hexdigest()) for j, x in enumerate(g)]
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame([(a, t, s, "clash", 1) for a, t, s in rows],
                                 "doc_id long, text string, source string, sha string, key int")


def test_brute_force(spark):
    got = [tuple(r) for r in m.exact_dedup(frame(spark, ROWS)).collect()]
    assert sorted(got, key=str) == brute(ROWS)


def test_many_rounds_and_tiny_filter(spark):
    rows = [(i, f"t{i % 400}", "s") for i in range(1000)]
    got = [tuple(r) for r in m.exact_dedup(frame(spark, rows), max_filter_bytes=1000).collect()]
    assert sorted(got, key=str) == brute(rows)


def test_rows_that_stay(spark):
    got = m.dedup_rows(frame(spark, ROWS))
    assert got.columns == ["doc_id", "text", "source", "sha", "key"]
    assert sorted((str(r.doc_id), r.text) for r in got.collect()) == sorted(
        [("5", "\t\n"), ("6", "zz"), ("7", " "), ("9", "q" * 30000 + "\x0b"), ("None", "ab  ")])


def test_empty(spark):
    assert m.exact_dedup(frame(spark, [])).collect() == []
    assert m.dedup_rows(frame(spark, [])).collect() == []


def test_pass_through_does_not_shuffle_rows(spark):
    rows = [(i, f"unique {i}", "s") for i in range(500)]
    table = m.digests(frame(spark, rows))
    split = m.split_repeats(table, 500, 16, 1 << 20)
    assert split.filter("_maybe").count() < 10


def test_least_and_greatest_ids(spark):
    least, most = -2**63, 2**63 - 1
    rows = [(least, "a b"), (most, "ab"), (0, "a b"), (most, "x"), (-1, "x"), (None, "x")]
    got = m.exact_dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in got.collect()), key=str) == sorted(
        [(least, least, 3, True), (most, least, 3, False), (0, least, 3, False), (most, -1, 3, False), (-1, -1, 3, True), (None, -1, 3, False)], key=str)
