"""Registered queries of the subpackage, name -> function of (spark, sf_dir), and their SQL twins."""

from __future__ import annotations

from critica.llm.chat_format import OP12_SQL, op12_chat_formatting
from critica.llm.conversation_repair import OP13_SQL, op13_conversation_repair
from critica.llm.decontaminate import OP9_SQL, op9_benchmark_decontamination
from critica.llm.html_extract import op2_html_extraction
from critica.llm.line_dedup import op3_line_dedup
from critica.llm.lm_score import op1_lm_scoring
from critica.llm.packing import op7_best_fit_packing
from critica.llm.pii import op8_pii
from critica.llm.quality import OP4_SQL, op4_quality_rules
from critica.llm.sharding import op5_ring_sharding
from critica.llm.simhash_dedup import op6_simhash_near_dedup
from critica.llm.token_count import op10_token_counts
from critica.llm.whitening import op11_embedding_whitening

QUERIES = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_html_extraction": op2_html_extraction,
    "op3_line_dedup": op3_line_dedup,
    "op4_quality_rules": op4_quality_rules,
    "op5_ring_sharding": op5_ring_sharding,
    "op6_simhash_near_dedup": op6_simhash_near_dedup,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_pii": op8_pii,
    "op9_benchmark_decontamination": op9_benchmark_decontamination,
    "op10_token_counts": op10_token_counts,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_chat_formatting": op12_chat_formatting,
    "op13_conversation_repair": op13_conversation_repair,
}

ORACLE = {
    "op4_quality_rules": OP4_SQL,
    "op9_benchmark_decontamination": OP9_SQL,
    "op12_chat_formatting": OP12_SQL,
    "op13_conversation_repair": OP13_SQL,
}
