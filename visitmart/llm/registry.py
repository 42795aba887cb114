"""The subpackage's registered queries and their oracle SQL."""

from __future__ import annotations

from .exact_dedup import OP1_SQL, op1_exact_dedup
from .jaccard import op6_jaccard_join
from .language import op4_language_id
from .lexical import OP11_SQL, op11_lexical_search
from .merkle import OP13_SQL, op13_merkle_manifest
from .mixing import OP8_SQL, op8_mixing
from .pieces import op3_sentencepiece
from .simhash import op12_simhash
from .substrings import OP5_SQL, op5_substring_dedup
from .tokens import op2_token_output
from .topk import OP7_SQL, op7_top_k
from .toxicity import op9_toxicity
from .warc import OP10_SQL, op10_warc

QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_token_output": op2_token_output,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_language_id": op4_language_id,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_top_k": op7_top_k,
    "op8_mixing": op8_mixing,
    "op9_toxicity": op9_toxicity,
    "op10_warc": op10_warc,
    "op11_lexical_search": op11_lexical_search,
    "op12_simhash": op12_simhash,
    "op13_merkle_manifest": op13_merkle_manifest,
}
SQL = {
    "op1_exact_dedup": OP1_SQL,
    "op5_substring_dedup": OP5_SQL,
    "op7_top_k": OP7_SQL,
    "op8_mixing": OP8_SQL,
    "op10_warc": OP10_SQL,
    "op11_lexical_search": OP11_SQL,
    "op13_merkle_manifest": OP13_SQL,
}
