"""Mixing sources to target weights by systematic sampling.

Every source has a target number of words (water filling, below). Its documents
stand in a fixed order; each has the same expected number of copies,
``target / source size``. The running sum of expected copies, shifted by one
random offset for the source, is cut at the integers: a document is emitted
once for each integer its step crosses. So a source emits its expected number
of copies to within one, and no document more than ``max_copies`` times.

The order goes by size class (four classes to an octave), then by a keyed hash,
so the systematic sample takes its share of every size class and the words come
near the target. A document's rank is found without gathering a source in one
task: (source, class, hash bucket) cells are counted with map-side partial
sums, a window over the cells gives each cell's first rank, and only the rows
of a cell are ranked together. Buckets grow with the number of rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .arrays import Words, release, slices, text_buffer

OFFSET_STEPS = 1 << 20


def word_count(text: Column) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+`` of a text (null: 0), counted on its bytes."""

    @F.arrow_udf("long")
    def count(column: pa.Array) -> pa.Array:
        raw, off = text_buffer(column)
        out = pa.array(np.concatenate([np.zeros(0, np.int64)] + [Words(raw[off[a]:off[z]], off[a:z + 1]).counts.astype(np.int64)
                                                                 for a, z in slices(off)]))
        release()
        return out

    return count(text)


def size_class(size: Column) -> Column:
    """Four classes to an octave, by integer arithmetic."""
    bits = F.length(F.bin(size))
    return F.when(size < 8, size).otherwise(bits * 4 + F.expr("shiftright(size, length(bin(size)) - 3) & 3"))


def unit_hash(value: Column, seed: int) -> Column:
    """60 bits of MD5 of "seed:value" as a long."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), value)), 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights=(1, 2, 3), max_copies: int = 3) -> DataFrame:
    """Targets from (source, source_size): weights go round in code point order
    of the sources (null last); targets add up to all sizes. Where a source's
    share would pass ``max_copies`` times its size it stops there and the rest is
    shared again. Sorted by size per weight, the stopped sources are a prefix.

    One row per source: the two windows run over sources, not documents.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    turn = (F.row_number().over(order) - 1) % len(weights)
    w = F.element_at(F.array(*[F.lit(int(x)) for x in weights]), (turn + 1).cast("int")).cast("long")
    s = sizes.withColumn("w", w).withColumn("cap", F.col("source_size") * max_copies)
    fill = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").isNull(), F.col("source"))
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    s = (s.withColumn("left", F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
          .withColumn("w_left", F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0)))
          .withColumn("stops", F.col("left") * F.col("w") >= F.col("cap") * F.col("w_left")))
    open_ = s.filter(~F.col("stops")).agg(F.max("left").alias("open_left"), F.max("w_left").alias("open_w"))
    return s.join(F.broadcast(open_)).select(            # one row: the level reached by the sources still open
        "source", "source_size",
        F.when(F.col("stops"), F.col("cap").cast("double"))
         .otherwise((F.col("open_left") * F.col("w")).cast("double") / F.col("open_w").cast("double")).alias("target"))


def mix(docs: DataFrame, seed: int = 17, weights=(1, 2, 3), max_copies: int = 3, rows_per_cell: int = 200_000,
        size: Column | None = None) -> DataFrame:
    """``docs`` plus ``_size``, ``_source_size``, ``_target``, ``_copies``.

    Needs doc_id, text, source. Null text: size 0. Null source: a source of its
    own, last in the order. Documents of size 0 take part like others (their
    words add nothing). Repeated rows are separate documents; their order among
    themselves does not change what is emitted. Empty table: no rows.
    """
    n = docs.count()
    buckets = max(1, n // rows_per_cell)
    body = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_r"))
    rows = (body.withColumn("size", size if size is not None else word_count(F.col("_r.text")))
                .withColumn("source", F.col("_r.source"))
                .withColumn("cls", size_class(F.col("size")))
                .withColumn("h", unit_hash(F.coalesce(F.col("_r.doc_id").cast("string"), F.lit("")), seed)))
    plain = [F.col(f"_r.`{c}`") for c, t in docs.dtypes if not t.startswith(("map", "array", "struct", "variant"))]
    span = (1 << 60) // buckets + 1
    rows = rows.withColumn("b", F.floor(F.col("h") / F.lit(span)).cast("long") if buckets > 1 else F.lit(0).cast("long"))
    cells = materialize(rows.groupBy("source", "cls", "b").agg(F.count("*").alias("n"), F.sum("size").alias("words")))
    targets = source_targets(cells.groupBy("source").agg(F.sum("words").alias("source_size")), weights, max_copies)
    first = Window.partitionBy("source").orderBy("cls", "b").rowsBetween(Window.unboundedPreceding, -1)
    placed = cells.withColumn("first", F.coalesce(F.sum("n").over(first), F.lit(0))).select(
        F.col("source").alias("s1"), F.col("cls").alias("c1"), F.col("b").alias("b1"), "first")
    cell_info = materialize(placed.join(targets, F.col("s1").eqNullSafe(F.col("source")))
                            .select("s1", "c1", "b1", "first", "source_size", "target"))
    local = Window.partitionBy("source", "cls", "b").orderBy("h", F.col("_r.doc_id"), "size", F.xxhash64(*plain))
    ranked = rows.withColumn("local", F.row_number().over(local))
    joined = ranked.join(cell_info, F.col("source").eqNullSafe(F.col("s1")) & (F.col("cls") == F.col("c1"))
                         & (F.col("b") == F.col("b1")))
    rank = (F.col("first") + F.col("local")).cast("double")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    u = (unit_hash(F.concat(F.lit("source:"), F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))), seed)
         % OFFSET_STEPS).cast("double") / F.lit(float(OFFSET_STEPS))
    copies = F.floor(rate * rank + u) - F.floor(rate * (rank - 1.0) + u)
    return joined.select("_r", F.col("size").alias("_size"), F.col("source_size").alias("_source_size"),
                         F.col("target").alias("_target"),
                         F.least(copies, F.lit(max_copies)).cast("long").alias("_copies"))


def mixed_rows(docs: DataFrame, **kw) -> DataFrame:
    """The mix itself: each document as often as it is emitted, columns of the input."""
    m = mix(docs, **kw).filter("_copies > 0")
    return m.select("_r", F.explode(F.array_repeat(F.lit(1), F.col("_copies").cast("int")))).select("_r.*")


def op8_mixing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    slim = docs.select("doc_id", "source", word_count(F.col("text")).alias("n_words"))
    m = mix(slim, size=F.col("_r.n_words"))
    return m.select(F.col("_r.doc_id").alias("doc_id"), F.col("_size").alias("size"),
                    F.col("_source_size").alias("source_size"), F.col("_target").alias("target"),
                    (F.col("_copies") * F.col("_size")).alias("taken"))


def mixing_sql(docs: str, seed: int = 17, max_copies: int = 3, rows_per_cell: int = 200_000) -> str:
    """CTEs of the mix over a relation with doc_id, text, source; last one: mixed."""
    return rf"""
sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5('{seed}:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h,
         md5('{seed}:source:' || coalesce('=' || source, '')) AS hs
  FROM {docs}),
classed AS (
  SELECT *, CASE WHEN size < 8 THEN size
                 ELSE length(bin(size)) * 4 + ((size >> (length(bin(size)) - 3)::INT) & 3) END AS cls FROM sized),
src AS (SELECT source, sum(size)::BIGINT AS source_size FROM classed GROUP BY source),
weighed AS (
  SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT AS w FROM src),
filled AS (
  SELECT *, {max_copies} * source_size AS cap,
         sum(source_size) OVER () - coalesce(sum({max_copies} * source_size) OVER f, 0) AS lft,
         sum(w) OVER () - coalesce(sum(w) OVER f, 0) AS w_left
  FROM weighed WINDOW f AS (ORDER BY ({max_copies} * source_size)::DOUBLE / w, source NULLS LAST
                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
stopped AS (SELECT *, lft * w >= cap * w_left AS stops FROM filled),
level AS (SELECT max(lft) AS open_left, max(w_left) AS open_w FROM stopped WHERE NOT stops),
targets AS (
  SELECT source, source_size, CASE WHEN stops THEN cap::DOUBLE
         ELSE (open_left * w)::DOUBLE / open_w::DOUBLE END AS target FROM stopped, level),
ranked AS (
  SELECT c.*, t.source_size, t.target,
         row_number() OVER (PARTITION BY c.source ORDER BY cls, h, doc_id)::DOUBLE AS k,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
         ((('0x' || substr(hs, 1, 15))::BIGINT % {OFFSET_STEPS})::DOUBLE / {float(OFFSET_STEPS)}::DOUBLE) AS u
  FROM classed c JOIN targets t ON c.source IS NOT DISTINCT FROM t.source),
mixed AS (
  SELECT *, least(floor(rate * k + u) - floor(rate * (k - 1) + u), {max_copies})::BIGINT AS copies FROM ranked)"""


OP8_SQL = "WITH " + mixing_sql("documents") + """
SELECT doc_id, size, source_size, target, copies * size AS taken FROM mixed"""
