"""The pipeline against plain versions of its stages, on a small corpus."""

import hashlib
import random
from collections import Counter, defaultdict

import corpus_pipeline as p
from visitmart.llm import arrays
from visitmart.llm.arrays import text_buffer

from .test_exact_dedup import brute as exact_brute
from .test_jaccard import brute as jaccard_brute
from .test_mixing import brute as mixing_brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = {"en": "the and of house river morning which through water over under".split(),
         "de": "der und nicht schön haus strasse über morgen wasser unter".split()}


def corpus():
    rng = random.Random(8)
    rows = []
    for i in range(90):
        lang = "de" if i % 3 == 0 else "en"
        rows.append((i, " ".join(rng.choice(WORDS[lang]) + str(rng.randrange(30)) for _ in range(rng.randint(1, 60))), lang, f"src{i % 4 if i % 2 else 0}"))
    rows += [(100 + i, rows[i][1].replace(" ", "\n") + " " * (i % 3), rows[i][2], "src1") for i in range(0, 30, 3)]         # exact copies
    rows += [(200 + i, rows[i][1] + " more", rows[i][2], None) for i in range(0, 60, 4)]                                    # near copies
    rows += [(300, None, "en", "src0"), (301, " \n", None, None), (302, "", "de", "src2"), (5, rows[5][1], rows[5][2], rows[5][3])]
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], SCHEMA)


def test_stages_against_plain_versions(spark):
    rows = corpus()
    docs = frame(spark, rows)
    stage = dict(p.STAGES)
    step = lambda name, df: sorted((tuple(r)[:4] for r in stage[name](spark, df, "").collect()), key=str)

    kept = [r for r in rows if (r[1] or "").strip()]                        # every text with words is in a language
    assert step("language_id", docs) == sorted(kept, key=str)

    group = defaultdict(list)
    for r in kept:
        group["".join(r[1].split())].append(r)
    one = [max(g, key=lambda r: (len(r[1]), -r[0])) for g in group.values()]
    assert step("exact_dedup", frame(spark, kept)) == sorted(one, key=str)
    assert {r[0] for r in one} == {r[1] for r in exact_brute([(a, t, s) for a, t, _, s in kept]) if r[3]}

    least = {d for d, _, comp in jaccard_brute([(r[0], r[1]) for r in one]) if d == comp}
    apart = [r for r in one if r[0] in least]
    assert len(apart) < len(one)
    assert step("jaccard_join", frame(spark, one)) == sorted(apart, key=str)

    _, copies = mixing_brute([(r[0], r[1], r[3]) for r in apart])
    times = {d: c for d, _, c in copies}
    mixed = [r for r in apart for _ in range(times[r[0]])]
    assert 0 < len(mixed) != len(apart)
    assert step("mixing", frame(spark, apart)) == sorted(mixed, key=str)

    last = stage["sentencepiece"](spark, frame(spark, mixed), "").collect()
    assert Counter((r.doc_id, r.text_sha256) for r in last) == Counter((d, hashlib.sha256(t.encode()).hexdigest()) for d, t, _, _ in mixed)
    assert all(r.lossless for r in last)


def test_run_applies_all_stages(spark, tmp_dir):
    rows = corpus()
    frame(spark, rows).write.parquet(f"{tmp_dir}/documents.parquet")
    got = Counter(tuple(r) for r in p.run(spark, tmp_dir).collect())
    docs = spark.read.parquet(f"{tmp_dir}/documents.parquet")
    for k, (_, stage) in enumerate(p.STAGES):
        docs = stage(spark, docs, tmp_dir)
        docs.write.parquet(f"{tmp_dir}/{k}")
        docs = spark.read.parquet(f"{tmp_dir}/{k}")
        assert k == len(p.STAGES) - 1 or docs.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    assert got == Counter(tuple(r) for r in docs.collect())


def test_empty_table(spark):
    docs = frame(spark, [])
    for _, stage in p.STAGES:
        docs = stage(spark, docs, "")
    assert docs.collect() == []


def test_text_buffer_of_slices():
    import pyarrow as pa

    raw, off = text_buffer(pa.array(["ab", None, "c", "dé"]).slice(1, 3))
    assert raw.tobytes() == "cdé".encode() and off.tolist() == [0, 0, 1, 4]


def test_workers_release_after_their_last_batch(monkeypatch):
    seen = []

    def run(batches):
        try:
            yield from batches
        finally:
            seen.append("ended")

    monkeypatch.setattr(arrays, "release", lambda: seen.append("released"))
    assert list(arrays.releasing(run)(iter([1, 2]))) == [1, 2]
    assert seen == ["ended", "released"]
