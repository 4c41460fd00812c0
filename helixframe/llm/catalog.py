"""The queries of this subpackage and the SQL that states their results."""

from __future__ import annotations

from . import additive_quantisation, bpe, chat, exact_dedup, filter_audit, merkle, ngram_join, packing, pseudonyms, quality, quality_rules, substring_dedup, toxicity

QUERIES = {
    "op10_quality": quality.op10_quality,
    "op7_toxicity": toxicity.op7_toxicity,
    "op2_pseudonyms": pseudonyms.op2_pseudonyms,
    "op1_additive_quantisation": additive_quantisation.op1_additive_quantisation,
    "op3_ngram_jaccard": ngram_join.op3_ngram_jaccard,
    "op9_packing": packing.op9_packing,
    "op4_substring_dedup": substring_dedup.op4_substring_dedup,
    "op5_bpe": bpe.op5_bpe,
    "op6_chat_formatting": chat.op6_chat_formatting,
    "op8_exact_dedup": exact_dedup.op8_exact_dedup,
    "op11_filter_audit": filter_audit.op11_filter_audit,
    "op12_quality_rules": quality_rules.op12_quality_rules,
    "op13_merkle_manifest": merkle.op13_merkle_manifest,
}

ORACLES = {**chat.SQL, **exact_dedup.SQL, **filter_audit.SQL, **merkle.SQL, **ngram_join.SQL, **substring_dedup.SQL}
