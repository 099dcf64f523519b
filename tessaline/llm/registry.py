"""Queries of the corpus operators, and the SQL of those that DuckDB can express."""

from __future__ import annotations

from . import decontaminate, langid, near_dup, packing, quality_model, quality_rules, secrets, tokens, toxicity, urls

QUERIES = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_language_id": langid.op2_language_id,
    "op3_token_counts": tokens.op3_token_counts,
    "op4_secrets": secrets.op4_secrets,
    "op5_packing": packing.op5_packing,
    "op6_decontamination": decontaminate.op6_decontamination,
    "op6_proximity": decontaminate.op6_proximity,
    "op7_url_filters": urls.op7_url_filters,
    "op8_quality_rules": quality_rules.op8_quality_rules,
    "op9_quality_classifier": quality_model.op9_quality_classifier,
    "op10_near_dup": near_dup.op10_near_dup,
}

ORACLE_SQL = {
    "op6_decontamination": decontaminate.OP6_SQL,
    "op7_url_filters": urls.OP7_SQL,
    "op10_near_dup": near_dup.OP10_SQL,
}
