"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from . import op1_bpe, op2_chat, op3_licenses, op4_decontaminate, op5_ngram_join, op6_token_files, op7_secrets, op8_suffix_dedup, op9_quality, op10_classifier, op11_prefix_trie, op12_resample, op13_packing

MODULES = [op1_bpe, op2_chat, op3_licenses, op4_decontaminate, op5_ngram_join, op6_token_files, op7_secrets, op8_suffix_dedup, op9_quality, op10_classifier,
           op11_prefix_trie, op12_resample, op13_packing]

QUERIES = {k: f for m in MODULES for k, f in m.QUERIES.items()}
ORACLE = {k: s for m in MODULES for k, s in m.ORACLE.items()}
