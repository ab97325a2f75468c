"""The registered queries of the corpus operators, and SQL where SQL can express them."""

from __future__ import annotations

from docweir.llm import conversations, exact_dedup, language_id, licences, lm_scoring, mixing, near_dedup, ogg, packing, sharding, toxicity, training_order, whitening

QUERIES = {
    "op1_ogg_media": ogg.op1_ogg_media,
    "op2_exact_dedup": exact_dedup.op2_exact_dedup,
    "op3_licence_scan": licences.op3_licence_scan,
    "op4_training_order": training_order.op4_training_order,
    "op5_mixing": mixing.op5_mixing,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_near_dedup": near_dedup.op7_near_dedup,
    "op8_packing": packing.op8_packing,
    "op9_sharding": sharding.op9_sharding,
    "op10_language_id": language_id.op10_language_id,
    "op11_whitening": whitening.op11_whitening,
    "op12_lm_scoring": lm_scoring.op12_lm_scoring,
    "op13_conversation_repair": conversations.op13_conversation_repair,
}

SQL = {
    "op2_exact_dedup": exact_dedup.SQL,
    "op5_mixing": mixing.SQL,
    "op7_near_dedup": near_dedup.SQL,
    "op9_sharding": sharding.SQL,
}
