"""The thin queries over the driver's tables, by name."""

from __future__ import annotations

from fragloom.llm import chat, decontamination, langid, line_dedup, mixing, quality, simhash, substring_dedup, suffix_dedup, token_counts

QUERIES = {
    "op1_token_counts": token_counts.query,
    "op2_quality_rules": quality.query,
    "op3_mixing": mixing.query,
    "op4_language_id": langid.query,
    "op5_suffix_dedup": suffix_dedup.query,
    "op6_simhash_dedup": simhash.query,
    "op7_chat_formatting": chat.query,
    "op8_substring_dedup": substring_dedup.query,
    "op9_decontamination": decontamination.query,
    "op10_line_dedup": line_dedup.query,
}
