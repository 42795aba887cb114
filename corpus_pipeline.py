"""Corpus pipeline over ``documents``, one operator to a stage.

Each stage is ``(spark, docs, sf_dir) -> DataFrame`` and works on all that its
predecessor kept; all but the last return the columns of ``documents``. The
last, SentencePiece with keyed merge-dropout, has no SQL form, so ORACLE_SQL is
None; ``tests/llm/test_pipeline.py`` holds the rows against a plain version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from visitmart.llm.exact_dedup import dedup_rows
from visitmart.llm.jaccard import one_per_component
from visitmart.llm.language import language_stage
from visitmart.llm.mixing import mixed_rows
from visitmart.llm.pieces import round_trip
from visitmart.session import materialize


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without words, or in no language the evidence supports, go."""
    return language_stage(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (blanks aside) the longest, then smallest id, stays."""
    return dedup_rows(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked at Jaccard 0.8 the one of smallest id stays."""
    return one_per_component(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are brought to their target weights; a document may come up to three times."""
    return mixed_rows(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of every text: doc_id, n_pieces, ids_crc32, text_sha256, lossless."""
    return round_trip(docs)


STAGES = [("language_id", language_id), ("exact_dedup", exact_dedup), ("jaccard_join", jaccard_join), ("mixing", mixing),
          ("sentencepiece", sentencepiece)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
