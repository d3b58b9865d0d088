"""The training-data queries by name, and SQL for those that SQL can express."""

from __future__ import annotations

from cellweave.llm import chat, exact_dedup, fim, lloyd, mixing, packing, quality_lm, quality_rules, repeats, secrets, simhash, toxicity
from cellweave.llm.common import reachable

QUERIES = {
    "op1_secret_ownership": secrets.op1_secret_ownership,
    "op2_simhash_ball": simhash.op2_simhash_ball,
    "op3_prefix_rendering": chat.op3_prefix_rendering,
    "op4_source_mix": mixing.op4_source_mix,
    "op5_packed_ids": packing.op5_packed_ids,
    "op6_kneser_ney": quality_lm.op6_kneser_ney,
    "op7_compression_bands": quality_rules.op7_compression_bands,
    "op8_clause_grammar": toxicity.op8_clause_grammar,
    "op9_chunk_recipes": exact_dedup.op9_chunk_recipes,
    "op10_best_fit": packing.op10_best_fit,
    "op11_fill_in_middle": fim.op11_fill_in_middle,
    "op12_radix_repeats": repeats.op12_radix_repeats,
    "op13_delta_lloyd": lloyd.op13_delta_lloyd,
}
QUERIES = {name: reachable(query) for name, query in QUERIES.items()}
ORACLE_SQL = {
    "op1_secret_ownership": secrets.ORACLE,
    "op3_prefix_rendering": chat.ORACLE,
    "op4_source_mix": mixing.ORACLE,
    "op9_chunk_recipes": exact_dedup.ORACLE,
    "op11_fill_in_middle": fim.ORACLE,
    "op12_radix_repeats": repeats.ORACLE,
    "op13_delta_lloyd": lloyd.ORACLE,
}
