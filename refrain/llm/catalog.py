"""The queries of this subpackage by name, with the SQL texts of those that SQL can state."""

from __future__ import annotations

from refrain.llm import (
    op1_near_dedup,
    op2_quality_rules,
    op3_toxicity,
    op4_byte_bpe,
    op5_secrets,
    op6_language_id,
    op7_substring_dedup,
    op8_chat_format,
    op9_exact_topk,
    op10_mixing,
    op11_ranked_search,
    op12_hard_negatives,
    op13_pieces,
)

MODULES = (
    op1_near_dedup,
    op2_quality_rules,
    op3_toxicity,
    op4_byte_bpe,
    op5_secrets,
    op6_language_id,
    op7_substring_dedup,
    op8_chat_format,
    op9_exact_topk,
    op10_mixing,
    op11_ranked_search,
    op12_hard_negatives,
    op13_pieces,
)
QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
