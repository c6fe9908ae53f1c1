"""DuckDB SQL of the queries that SQL can express, by name."""

from __future__ import annotations

from fragloom.llm import chat, decontamination, line_dedup, substring_dedup

ORACLES = {
    "op7_chat_formatting": chat.SQL,
    "op8_substring_dedup": substring_dedup.SQL,
    "op9_decontamination": decontamination.SQL,
    "op10_line_dedup": line_dedup.SQL,
}
