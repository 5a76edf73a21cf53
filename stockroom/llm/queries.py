"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from stockroom.llm import oracles
from stockroom.llm.bpe import op1_bpe
from stockroom.llm.chosen_path import op8_jaccard_join
from stockroom.llm.conversation_repair import op13_conversation_repair
from stockroom.llm.html_extract import op6_html
from stockroom.llm.packing import op5_packing
from stockroom.llm.quality_fm import op3_quality_fm
from stockroom.llm.quality_rules import op7_quality_rules
from stockroom.llm.sharding import op10_sharding
from stockroom.llm.simhash_golay import op12_simhash
from stockroom.llm.spelling_variants import op11_spelling_variants
from stockroom.llm.substring_dedup import op4_substring_dedup
from stockroom.llm.suffix_dedup import op2_suffix_dedup
from stockroom.llm.topk import op9_topk

QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_quality_fm": op3_quality_fm,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_packing": op5_packing,
    "op6_html": op6_html,
    "op7_quality_rules": op7_quality_rules,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_topk": op9_topk,
    "op10_sharding": op10_sharding,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_simhash": op12_simhash,
    "op13_conversation_repair": op13_conversation_repair,
}

ORACLE_SQL: dict[str, str] = {
    "op4_substring_dedup": oracles.SUBSTRING_DEDUP,
    "op9_topk": oracles.TOP_K,
    "op11_spelling_variants": oracles.SPELLING_VARIANTS,
    "op13_conversation_repair": oracles.CONVERSATION_REPAIR,
}
