"""Registered queries of the operators and the SQL that states them."""

from __future__ import annotations

from spendcast.llm import (
    bpe, classifier, divergence, exact_dedup, fingerprints, lm_score, mixing, near_dup, rules, secrets,
    substring_dedup, suffix_dedup, whitening,
)

QUERIES = {
    "op1_suffix_dedup": suffix_dedup.suffix_query,
    "op2_lm_score": lm_score.lm_query,
    "op3_quality_classifier": classifier.classifier_query,
    "op4_quality_rules": rules.rules_query,
    "op5_mix_sources": mixing.mixing_query,
    "op6_minhash": near_dup.near_dup_query,
    "op7_secret_scan": secrets.secrets_query,
    "op8_fingerprints": fingerprints.fingerprint_query,
    "op9_byte_bpe": bpe.bpe_query,
    "op10_substring_dedup": substring_dedup.substring_query,
    "op11_source_divergence": divergence.divergence_query,
    "op12_exact_dedup": exact_dedup.exact_query,
    "op13_whitening": whitening.whitening_query,
}

ORACLES = {
    "op5_mix_sources": mixing.MIXING_SQL,
    "op11_source_divergence": divergence.DIVERGENCE_SQL,
    "op12_exact_dedup": exact_dedup.EXACT_SQL,
}
