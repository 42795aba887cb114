import math
import random
from collections import defaultdict

import numpy as np
import pyarrow as pa

from visitmart.llm import language as m
from visitmart.llm.arrays import GRAM, GRAM_OF, text_buffer

WORDS = {"en": "the and of house river morning which through".split(), "de": "der und nicht schön haus strasse über morgen".split(),
         "fr": "le et dans maison rivière être pourquoi matin".split()}


def corpus(n=150, seed=5):
    rng = random.Random(seed)
    return [(i, " ".join(rng.choice(WORDS[lang]) for _ in range(rng.randint(1, 30))), lang, f"src{i % 3}")
            for i in range(n) for lang in [("en", "de", "fr")[i % 3]]]


def grams(text):
    data = b" " + text.encode().lower().replace(b"\n", b" ") + b" " * 9
    for i in range(len(text.encode()) + 1):
        for n in m.SIZES:
            g = data[i:i + n]
            if b" " not in g[1:n - 1] and g[:2] != b"  ":
                yield ((int.from_bytes(g, "little") ^ GRAM_OF[n]) * GRAM % 2**64) >> (64 - m.BITS)


def test_counts_against_brute_force():
    raw, off = text_buffer(pa.array(["Ab cd", None, "x\ny ñandú"]))
    got = m.gram_counts(raw, off)
    want = np.bincount([g for t in ("Ab cd", "", "x\ny ñandú") for g in grams(t)], minlength=1 << m.BITS)
    assert (got == want).all()


def levels(address):
    host = (address or "").lower().split("//")[-1].split("/")[0].split("?")[0].split(":")[0]
    parts = host.split(".")
    return host, ".".join(parts[-2:]), parts[-1] if len(parts) > 1 else ""


def brute(rows, langs, logp):
    """The fusion rule, row by row. rows: (key, text, declared, address)."""
    L, ev = len(langs), []
    for key, text, declared, address in rows:
        g = list(grams(text or ""))
        ll = [sum(float(logp[k][x]) for x in g) / max(1, len(g)) * m.TEXT_POWER * math.sqrt(max(1, len(g))) for k in range(L)]
        if declared in langs:
            ll = [x + math.log(0.9 if lang == declared else 0.1 / (L - 1)) for x, lang in zip(ll, langs)]
        ll = [x - max(ll) for x in ll]
        total = sum(map(math.exp, ll))
        ev.append((key, len(g), ll, [math.exp(x) / total if g else 0 for x in ll], levels(address)))
    sums = defaultdict(lambda: [0.0] * L)
    for _, _, _, part, (h, d, s) in ev:
        for name in (("h", h, d, s), ("d", d, s), ("s", s), ("a",)):
            sums[name] = [a + b for a, b in zip(sums[name], part)]
    for key, n, ll, part, (h, d, s) in ev:
        level = [1 / L] * L
        for name, k0 in ((("a",), L), (("s", s), 10), (("d", d, s), 10), (("h", h, d, s), 10)):
            if name[0] == "s" and m.SUFFIX_LANGUAGE.get(s) in langs:
                level = [0.8 if lang == m.SUFFIX_LANGUAGE[s] else 0.2 / (L - 1) for lang in langs]
            own = [a - b for a, b in zip(sums[name], part)]
            level = [(own[k] + k0 * level[k]) / (sum(own) + k0) for k in range(L)]
        z = [a + math.log(b) for a, b in zip(ll, level)]
        p = [math.exp(x - max(z)) for x in z]
        yield key, n, langs[z.index(max(z))], max(p) / sum(p)


def rows_of(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], "key long, text string, declared string, address string, host string")


def test_fusion_against_brute_force(spark):
    data = corpus()
    docs = spark.createDataFrame(data, "id long, text string, lang string, source string")
    model = m.fit(docs)
    assert model[0] == ["de", "en", "fr"]
    rows = [(i, t if i % 7 else None, (None, "de", "xx")[i % 3], (f"https://h{i % 4}.dom{i % 2}.{('com', 'de')[i % 2]}/p?{i}", s, None)[i % 5 % 3])
            for i, t, _, s in data] + [(900, "", "fr", "http://x.fr/"), (900, "", "fr", "http://x.fr/"), (None, "zz " * 5000, None, "")]
    got = sorted(((r.key, r.n_grams, r.lang, r.posterior) for r in m.identify(rows_of(spark, rows), model).collect()), key=str)
    want = sorted(brute(rows, *model), key=str)
    assert [x[:3] for x in got] == [x[:3] for x in want]
    assert np.allclose([x[3] for x in got], [x[3] for x in want], atol=1e-4)


def test_accuracy_on_rows_not_trained_on(spark):
    model = m.fit(spark.createDataFrame(corpus(), "id long, text string, lang string, source string"))
    new = [(i, t, None, None) for i, t, _, _ in corpus(90, seed=9) if len(t) > 30]
    truth = {i: lang for i, t, lang, _ in corpus(90, seed=9)}
    got = m.identify(rows_of(spark, new), model).collect()
    assert sum(r.lang == truth[r.key] for r in got) >= 0.95 * len(new)


def test_rare_languages_stay_in_the_model(spark):
    """However many rows the common languages have, and where a language's rows share an id."""
    rows = [(i, "the and of house", "en") for i in range(3000)] + [(None, "le et dans", "fr")] * 40 + [(5000 + i, "der und nicht", f"x{i}") for i in range(8)]
    langs, logp = m.fit(spark.createDataFrame(rows, "id long, text string, lang string"), sample_rows=20)
    assert langs == sorted({lang for _, _, lang in rows}) and len(logp) == 10


def test_stage_keeps_clean_rows_and_columns(spark):
    docs = spark.createDataFrame([(i, t, lang, s, 3) for i, t, lang, s in corpus()] + [(500, None, None, None, 0), (501, " \n", "en", "src1", 2)],
                                 "doc_id long, text string, lang string, source string, n_grams int")
    out = m.language_stage(docs)
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.collect()) == list(range(150))


def test_stage_with_clashing_column_names(spark):
    docs = spark.createDataFrame([(i, t, lang, s, 3, "x") for i, t, lang, s in corpus()] + [(500, None, None, None, 0, "y")],
                                 "doc_id long, text string, lang string, source string, _bad_id int, _bad_t string")
    out = m.language_stage(docs)
    assert out.columns == docs.columns and sorted(r.doc_id for r in out.collect()) == list(range(150))


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "abc", None, "s"), (2, "", None, None)], "doc_id long, text string, lang string, source string")
    assert [r.doc_id for r in m.language_stage(docs).collect()] == [1]
    assert m.language_stage(docs.limit(0)).collect() == []


def test_address_levels(spark):
    df = spark.createDataFrame([("http://User@A.B.example.DE:80/x",), ("src0",), (None,), ("https://x.org?y",)], "a string")
    assert [tuple(r) for r in df.select(*m.address_levels(m.F.col("a"))).collect()] == [
        ("a.b.example.de", "example.de", "de"), ("src0", "src0", ""), ("", "", ""), ("x.org", "x.org", "org")]


def test_html_evidence(spark):
    df = spark.createDataFrame([("<HTML class=a lang='fr-CA'><script>var t='</p>';</script><p>Oui<!-- no --></p>",), (None,)], "h string")
    got = [(r[0].split(), r[1]) for r in df.select(*m.html_evidence(m.F.col("h"))).collect()]
    assert got == [(["Oui"], "fr"), ([], "")]
