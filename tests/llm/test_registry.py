import re

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from visitmart.llm.registry import QUERIES, SQL


def test_one_query_for_each_operator_and_the_pipeline():
    assert sorted(int(re.match(r"op(\d+)_", q)[1]) for q in QUERIES) == list(range(1, 14))
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())
    assert entry.queries()["pipeline"] is corpus_pipeline.run
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "jaccard_join", "mixing", "sentencepiece"]


@pytest.mark.parametrize("columns,name", [
    ("doc_id keep_id group_size kept text_sha256", "op1_exact_dedup"),
    ("doc_id start n_tokens ids_crc32", "op2_token_output"),
    ("doc_id n_words n_removed kept_sha256", "op5_substring_dedup"),
    ("doc_id n_shingles component_id", "op6_jaccard_join"),
    ("query_id rank vec_id score", "op7_top_k"),
    ("doc_id size source_size target taken", "op8_mixing"),
    ("doc_id held_out score predicted", "op9_toxicity"),
    ("item_id rank doc_id score", "op11_lexical_search"),
    ("doc_id fingerprint component_id", "op12_simhash"),
    ("doc_id leaf subroot root proof_sha256 folded_root verified", "op13_merkle_manifest"),
    ("page_id payload_bytes payload_digest record_type refers_to", "op10_warc"),
])
def test_contract_columns(spark, columns, name):
    types = {"kept": "boolean", "held_out": "boolean", "target": "double", "score": "double" if name.startswith("op9") else "bigint",
             "rank": "int", "predicted": "int", "text_sha256": "string", "kept_sha256": "string", "payload_digest": "string",
             "record_type": "string", "verified": "boolean", **dict.fromkeys("fingerprint leaf subroot root proof_sha256 folded_root".split(), "string")}
    got = dict(QUERIES[name](spark, "/root/testdata/sf0.001").dtypes)
    assert {c: got.get(c) for c in columns.split()} == {c: types.get(c, "bigint") for c in columns.split()}
