"""The registered queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from . import bpe, chat, decontaminate, line_dedup, lm_score, merkle, near_dedup, quality, resample, secrets, suffix_dedup, token_store, url_filter

QUERIES = {
    "op1_url_filter": url_filter.op1_url_filter,
    "op2_decontaminate": decontaminate.op2_decontaminate,
    "op3_secret_scan": secrets.op3_secret_scan,
    "op4_quality_rules": quality.op4_quality_rules,
    "op5_token_store": token_store.op5_token_store,
    "op6_lm_score": lm_score.op6_lm_score,
    "op7_near_dedup": near_dedup.op7_near_dedup,
    "op8_byte_bpe": bpe.op8_byte_bpe,
    "op9_chat_format": chat.op9_chat_format,
    "op10_line_dedup": line_dedup.op10_line_dedup,
    "op11_merkle_manifest": merkle.op11_merkle_manifest,
    "op12_importance_resample": resample.op12_importance_resample,
    "op13_suffix_dedup": suffix_dedup.op13_suffix_dedup,
}

ORACLE_SQL = {
    "op1_url_filter": url_filter.OP1_SQL,
    "op2_decontaminate": decontaminate.OP2_SQL,
    "op7_near_dedup": near_dedup.OP7_SQL,
    "op9_chat_format": chat.OP9_SQL,
    "op10_line_dedup": line_dedup.OP10_SQL,
    "op11_merkle_manifest": merkle.OP11_SQL,
    "op12_importance_resample": resample.OP12_SQL,
}
