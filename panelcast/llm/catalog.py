"""Queries of the operators and their DuckDB SQL, one module each."""

from __future__ import annotations

from panelcast.llm import conversation_repair, decontaminate, hard_negatives, html_text, language_id, lm_score, mixing, pieces, quality, simhash, substring_dedup, toxicity, url_rules

MODULES = (substring_dedup, url_rules, simhash, language_id, decontaminate, toxicity, html_text, lm_score, quality, pieces, mixing, conversation_repair, hard_negatives)


def queries() -> dict:
    return {k: v for m in MODULES for k, v in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for m in MODULES for k, v in m.SQL.items()}
