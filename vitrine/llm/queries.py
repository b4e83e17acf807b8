"""Registered queries of the corpus operators and, where SQL can express them, their DuckDB twins."""

from __future__ import annotations

import corpus_pipeline
from vitrine.llm import (
    op1_simhash,
    op2_language_id,
    op3_licenses,
    op4_sharding,
    op5_token_counts,
    op6_mtree,
    op7_mixing,
    op8_exact_dedup,
    op9_bpe,
    op10_quality,
    op11_line_dedup,
    op12_prefix_trie,
    op13_periodic_runs,
)

QUERIES = {
    "op1_simhash": op1_simhash.op1_simhash,
    "op2_language_id": op2_language_id.op2_language_id,
    "op3_licenses": op3_licenses.op3_licenses,
    "op4_sharding": op4_sharding.op4_sharding,
    "op5_token_counts": op5_token_counts.op5_token_counts,
    "op6_mtree": op6_mtree.op6_mtree,
    "op7_mixing": op7_mixing.op7_mixing,
    "op8_exact_dedup": op8_exact_dedup.op8_exact_dedup,
    "op9_bpe": op9_bpe.op9_bpe,
    "op10_quality": op10_quality.op10_quality,
    "op11_line_dedup": op11_line_dedup.op11_line_dedup,
    "op12_prefix_trie": op12_prefix_trie.op12_prefix_trie,
    "op13_periodic_runs": op13_periodic_runs.op13_periodic_runs,
    "pipeline": corpus_pipeline.run,
}

ORACLE = {
    "op6_mtree": op6_mtree.SQL,
    "op7_mixing": op7_mixing.SQL,
    "op8_exact_dedup": op8_exact_dedup.SQL,
    "op11_line_dedup": op11_line_dedup.SQL,
    "op12_prefix_trie": op12_prefix_trie.SQL,
}

if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
