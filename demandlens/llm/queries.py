"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

import corpus_pipeline
from demandlens.llm.bpe import op9_byte_bpe
from demandlens.llm.chat_repair import op13_chat_repair
from demandlens.llm.chat_windows import op11_chat_windows
from demandlens.llm.entropy_mix import op2_entropy_mix
from demandlens.llm.line_dedup import OP7_SQL, op7_line_dedup
from demandlens.llm.lm_score import op6_cross_entropy
from demandlens.llm.ngram_join import OP8_SQL, op8_ngram_join
from demandlens.llm.quality_rules import op10_quality_rules
from demandlens.llm.sharding import OP1_SQL, op1_lookup_sharding
from demandlens.llm.suffix_dedup import op4_suffix_dedup
from demandlens.llm.token_align import op12_token_align
from demandlens.llm.topk_search import OP5_SQL, op5_nra_topk
from demandlens.llm.toxicity import op3_toxicity

QUERIES = {
    "op1_lookup_sharding": op1_lookup_sharding,
    "op2_entropy_mix": op2_entropy_mix,
    "op3_toxicity": op3_toxicity,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_nra_topk": op5_nra_topk,
    "op6_cross_entropy": op6_cross_entropy,
    "op7_line_dedup": op7_line_dedup,
    "op8_ngram_join": op8_ngram_join,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_quality_rules": op10_quality_rules,
    "op11_chat_windows": op11_chat_windows,
    "op12_token_align": op12_token_align,
    "op13_chat_repair": op13_chat_repair,
    "pipeline": corpus_pipeline.run,
}

ORACLE_SQL = {
    "op1_lookup_sharding": OP1_SQL,
    "op5_nra_topk": OP5_SQL,
    "op7_line_dedup": OP7_SQL,
    "op8_ngram_join": OP8_SQL,
}
