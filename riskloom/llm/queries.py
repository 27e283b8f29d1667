"""The queries of this package and their SQL oracles; modules hold the operators themselves."""

from __future__ import annotations

from riskloom.llm import (
    bpe,
    chat,
    decontaminate,
    exact_dedup,
    hard_negatives,
    jaccard_join,
    language_id,
    licenses,
    lm_scoring,
    quality,
    spelling,
    token_counts,
    toxicity,
)

QUERIES = {
    f.__name__: f
    for f in (
        lm_scoring.op1_lm_scoring,
        language_id.op2_language_id,
        decontaminate.op3_decontamination,
        chat.op4_chat_formatting,
        exact_dedup.op5_exact_dedup,
        toxicity.op6_toxicity,
        licenses.op7_licenses,
        bpe.op8_bpe,
        quality.op9_quality,
        jaccard_join.op10_jaccard_join,
        token_counts.op11_token_counts,
        hard_negatives.op12_hard_negatives,
        spelling.op13_spelling_variants,
    )
}
ORACLES = {"op4_chat_formatting": chat.OP4_SQL, "op5_exact_dedup": exact_dedup.OP5_SQL, "op12_hard_negatives": hard_negatives.OP12_SQL}
