"""Language identification by fusing evidence with Bayes' rule.

Four sources, as log-likelihoods or priors over the languages of the model:

* text: naive Bayes over hashed character n-grams (2 to 4 bytes). N-grams
  overlap, so n of them count as ``TEXT_POWER * sqrt(n)`` independent ones;
* declared markup language (``<html lang=...>``): right with a set probability;
* address suffix: a country suffix raises its language in the suffix's prior;
* host: the language mix of the host, smoothed towards its domain, that towards
  the suffix, that towards all rows. The mix is a grouped sum of each row's own
  posterior (text and markup); a row's own part is taken out again before
  it meets its prior, so it does not vote twice.

Sums are of fixed-point numbers, so results do not depend on task order. Only a
row's key and its L numbers shuffle, never texts. Rows with no n-gram, or whose
best posterior is below ``min_posterior``, are rejected.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .arrays import ngrams, release, releasing, slices, text_buffer

BITS, SIZES = 15, (2, 3, 4)
FIXED = 1 << 20
TEXT_POWER = 2.0
# Country suffixes whose pages are mostly in one language.
SUFFIX_LANGUAGE = {"de": "de", "at": "de", "fr": "fr", "es": "es", "mx": "es", "ar": "es", "uk": "en", "us": "en",
                   "au": "en", "ie": "en", "nz": "en", "it": "it", "nl": "nl", "pt": "pt", "br": "pt", "pl": "pl"}


# -- text model --------------------------------------------------------------

def gram_counts(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    out = np.zeros(1 << BITS, np.int64)
    for a, z in slices(offsets, 1 << 19):
        for bucket, ok in ngrams(raw[offsets[a]:offsets[z]], offsets[a:z + 1] - offsets[a], SIZES, BITS)[0]:
            out += np.bincount(bucket[ok], minlength=1 << BITS)
    return out


def fit(labelled: DataFrame, sample_rows: int = 20_000) -> tuple[list[str], np.ndarray]:
    """Languages and log p(n-gram | language) from (id, text, lang) rows, on a
    sample by id hash of about ``sample_rows`` rows of each language (all, if there
    are fewer). The least hash of a language is always in, so none is lost."""
    rows = labelled.filter(F.col("lang").isNotNull() & (F.col("lang") != "") & F.col("text").isNotNull())
    h, n = F.shiftrightunsigned(F.xxhash64("id"), 11), F.col("n")                        # 53 bits
    limits = materialize(rows.groupBy("lang").agg(F.count("*").alias("n"), F.min(h).alias("least"))
                         .select("lang", F.when(n <= sample_rows, F.lit(1 << 53))
                                 .otherwise(F.greatest("least", (F.lit(float(sample_rows << 53)) / n).cast("long"))).alias("limit")))
    rows = rows.join(F.broadcast(limits), "lang").filter(h <= F.col("limit"))              # one row per language

    def count(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            for lang in set(langs):
                raw, off = text_buffer(batch.column(1).filter(pa.array(langs == lang)))
                total[lang] = total.get(lang, 0) + gram_counts(raw, off)
        yield pa.RecordBatch.from_pydict({"lang": pa.array(list(total), pa.string()),
                                          "counts": pa.array([c.tobytes() for c in total.values()], pa.binary())})

    def add(table: pa.Table) -> pa.Table:
        s = sum(np.frombuffer(x.as_py(), np.int64) for x in table["counts"])
        return pa.table({"lang": table["lang"][:1], "counts": pa.array([s.tobytes()], pa.binary())})

    got = (rows.select("lang", "text").mapInArrow(releasing(count), "lang string, counts binary")
           .groupBy("lang").applyInArrow(add, "lang string, counts binary").collect())   # one row per language
    got.sort(key=lambda r: r["lang"])
    counts = np.array([np.frombuffer(r["counts"], np.int64) for r in got], float).reshape(len(got), 1 << BITS)
    logp = np.log(counts + 0.1) - np.log(counts.sum(1, keepdims=True) + 0.1 * (1 << BITS))
    return [r["lang"] for r in got], logp.astype(np.float32)


def text_evidence(raw: np.ndarray, offsets: np.ndarray, logp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(n-grams, tempered log-likelihoods) of each row."""
    n_rows = len(offsets) - 1
    count, out = np.zeros(n_rows, np.int64), np.zeros((n_rows, len(logp)))
    for a, z in slices(offsets, 1 << 18):
        grams, starts = ngrams(raw[offsets[a]:offsets[z]], offsets[a:z + 1] - offsets[a], SIZES, BITS)
        count[a:z] = np.add.reduceat(sum(ok.astype(np.int64) for _, ok in grams), starts)
        for k, values in enumerate(logp):
            out[a:z, k] = np.add.reduceat(sum(np.where(ok, values[bucket], 0).astype(np.float64) for bucket, ok in grams), starts)
    n = np.maximum(count, 1)[:, None]
    return count, out / n * TEXT_POWER * np.sqrt(n)


# -- evidence and fusion -----------------------------------------------------

def address_levels(address: Column) -> tuple[Column, Column, Column]:
    """(host, domain, suffix) of an address or a bare host name; '' without one."""
    a = F.lower(F.trim(F.coalesce(address, F.lit(""))))
    host = F.regexp_replace(F.regexp_extract(a, r"^(?:[a-z][a-z0-9+.-]*:)?(?://)?(?:[^/?#@]*@)?([^/:?#]*)", 1), r"\.+$", "")
    return host, F.regexp_extract(host, r"([^.]*(?:\.[^.]*)?)$", 1), F.regexp_extract(host, r"\.([^.]+)$", 1)


def identify(rows: DataFrame, model: tuple[list[str], np.ndarray], markup_right: float = 0.9, strength: float = 10.0,
             suffix_right: float = 0.8, min_posterior: float = 0.5) -> DataFrame:
    """``rows``: (key, text, declared, address), key any type. Returns key,
    n_grams, lang, posterior, accepted; a row for each input row.

    Null or empty text, no words: no text evidence, rejected (lang is then the
    prior's choice). Unknown or null declared language, null address: no
    evidence from it. A model without languages rejects only rows without
    n-grams; lang and posterior are null. Ties go to the first language by
    name. Empty table: no rows.
    """
    langs, logp = model
    shared = rows.sparkSession.sparkContext.broadcast(logp)        # languages x 2**BITS floats
    L = len(langs)
    right, wrong = np.log(markup_right), np.log((1 - markup_right) / max(1, L - 1))

    def weigh(batches):
        for batch in batches:
            raw, off = text_buffer(batch.column(1))
            n, ll = text_evidence(raw, off, shared.value)
            if L:
                tag = np.array([(x or "").strip().lower().replace("_", "-").split("-")[0] for x in batch.column(2).to_pylist()], object)
                for k, lang in enumerate(langs):
                    ll[:, k] += np.where(np.isin(tag, langs), np.where(tag == lang, right, wrong), 0)
                ll -= ll.max(1, keepdims=True)
            p = np.exp(ll)
            part = np.floor(p / p.sum(1, keepdims=True) * FIXED).astype(np.int64) if L else p.astype(np.int64)
            part[n == 0] = 0
            lists = lambda x, t: pa.ListArray.from_arrays(pa.array(np.arange(0, len(n) * L + 1, max(L, 1))[:len(n) + 1] if L else np.zeros(len(n) + 1, int), pa.int32()), pa.array(x.ravel(), t))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(3), batch.column(4), batch.column(5), pa.array(n),
                                              lists(ll, pa.float64()), lists(part, pa.int64())],
                                             names=["key", "host", "domain", "suffix", "n_grams", "ll", "part"])
            release()

    host, domain, suffix = address_levels(F.col("address"))
    kind = rows.schema["key"].dataType.simpleString()
    evidence = materialize(rows.select("key", "text", F.col("declared").cast("string"), host.alias("host"), domain.alias("domain"),
                                       suffix.alias("suffix"))
                           .mapInArrow(releasing(weigh), f"key {kind}, host string, domain string, suffix string, n_grams long, "
                                              "ll array<double>, part array<long>"))
    if not L:
        return evidence.select("key", "n_grams", F.lit(None).cast("string").alias("lang"),
                               F.lit(None).cast("double").alias("posterior"), (F.col("n_grams") > 0).alias("accepted"))

    def sums(prefix, cols):
        return [F.sum(c).alias(f"{prefix}{k}") for k, c in enumerate(cols)]

    hosts = evidence.groupBy("host", "domain", "suffix").agg(*sums("h", [F.col("part")[k] for k in range(L)]))
    domains = hosts.groupBy("domain", "suffix").agg(*sums("d", [F.col(f"h{k}") for k in range(L)]))
    suffixes = domains.groupBy("suffix").agg(*sums("s", [F.col(f"d{k}") for k in range(L)]))
    every = suffixes.agg(*sums("a", [F.col(f"s{k}") for k in range(L)]))                   # one row
    prior = materialize(hosts.join(domains, ["domain", "suffix"]).join(suffixes, "suffix").join(F.broadcast(every))
                        .withColumnRenamed("host", "_host").drop("domain"))

    country = F.create_map(*[F.lit(x) for kv in SUFFIX_LANGUAGE.items() for x in kv])[F.col("suffix")]
    joined = evidence.drop("suffix").join(prior, F.col("host") == F.col("_host"))
    level = [F.lit(1.0 / L)] * L
    for letter, k0 in (("a", float(L)), ("s", strength), ("d", strength), ("h", strength)):
        own = [(F.col(f"{letter}{k}") - F.col("part")[k]).cast("double") / FIXED for k in range(L)]
        total = sum(own[1:], own[0])
        if letter == "s":
            known = country.isin(langs)
            level = [F.when(known, F.when(country == lang, suffix_right).otherwise((1 - suffix_right) / max(1, L - 1)))
                     .otherwise(p) for lang, p in zip(langs, level)]
        level = [(own[k] + k0 * level[k]) / (total + k0) for k in range(L)]
        names = [f"_{letter}p{k}" for k in range(L)]
        joined = joined.withColumns(dict(zip(names, level)))
        level = [F.col(x) for x in names]
    z = F.array(*[F.col("ll")[k] + F.log(level[k]) for k in range(L)])
    out = joined.select("key", "n_grams", z.alias("z")).withColumn("top", F.array_max("z"))
    return out.select(
        "key", "n_grams",
        F.element_at(F.array(*[F.lit(x) for x in langs]), F.array_position("z", F.col("top")).cast("int")).alias("lang"),
        (1.0 / F.aggregate("z", F.lit(0.0), lambda s, x: s + F.exp(x - F.col("top")))).alias("posterior"),
    ).withColumn("accepted", (F.col("n_grams") > 0) & (F.col("posterior") >= min_posterior))


def html_evidence(html: Column) -> tuple[Column, Column]:
    """(visible text, declared language) of a page."""
    h = F.coalesce(html, F.lit(""))
    text = F.regexp_replace(h, r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->|<[^>]*>", " ")
    return text, F.regexp_extract(h, r"(?i)<html\b[^>]*?\slang\s*=\s*[\"']?([A-Za-z]{2,3}\b)", 1)


def document_rows(docs: DataFrame) -> DataFrame:
    """Documents as evidence rows: their source stands for the host."""
    return docs.select(F.struct(F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("t")).alias("key"),
                       F.col("text"), F.lit(None).cast("string").alias("declared"), F.col("source").cast("string").alias("address"))


def fit_documents(docs: DataFrame, sample_rows: int = 20_000):
    return fit(docs.select(F.col("doc_id").alias("id"), F.col("text"), F.col("lang")), sample_rows)


def op4_language_id(spark, sf_dir: str) -> DataFrame:
    """All documents and all pages, each judged with what it has: rows of
    documents have doc_id, rows of pages have page_id."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    text, declared = html_evidence(F.col("html"))
    key = F.struct(F.lit("document").alias("kind"), F.col("doc_id").cast("long").alias("id")).alias("key")
    page_key = F.struct(F.lit("page").alias("kind"), F.col("page_id").cast("long").alias("id")).alias("key")
    rows = docs.select(key, "text", F.lit(None).cast("string").alias("declared"), F.col("source").alias("address")).unionByName(
        pages.select(page_key, text.alias("text"), declared.alias("declared"), F.col("url").alias("address")))
    out = identify(rows, fit_documents(docs))
    return out.select(F.when(F.col("key.kind") == "document", F.col("key.id")).alias("doc_id"),
                      F.when(F.col("key.kind") == "page", F.col("key.id")).alias("page_id"),
                      "lang", F.round("posterior", 6).alias("posterior"), "accepted")


def language_stage(docs: DataFrame, **kw) -> DataFrame:
    """The documents that are accepted, all columns. Rejects are few: only their
    keys meet the documents again, by broadcast while they are under a million."""
    bad = materialize(identify(document_rows(docs), fit_documents(docs), **kw).filter(~F.col("accepted"))
                      .select(F.col("key.id").alias("_bad_id"), F.col("key.t").alias("_bad_t")).distinct())
    n = bad.count()
    if not n:
        return docs
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_r"))
    return rows.join(F.broadcast(bad) if n < 1_000_000 else bad,
                     F.col("_r.doc_id").eqNullSafe(F.col("_bad_id")) & (F.xxhash64("_r.text") == F.col("_bad_t")), "left_anti").select("_r.*")
