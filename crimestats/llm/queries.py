"""Queries of the operators over the given tables, and the DuckDB SQL of those that SQL expresses."""

from __future__ import annotations

from crimestats.llm import (ball_codes, byte_bpe, byte_language, chat_format, host_quality, lattice_dedup, license_scan, maxent_lm,
                            middle_fill, ngram_join, sentence_pieces, source_mix, token_counts)

MODULES = {
    "op1_host_quality": host_quality,
    "op2_license_scan": license_scan,
    "op3_language_id": byte_language,
    "op4_ngram_join": ngram_join,
    "op5_chat_format": chat_format,
    "op6_sentence_pieces": sentence_pieces,
    "op7_maxent_lm": maxent_lm,
    "op8_lattice_dedup": lattice_dedup,
    "op9_token_counts": token_counts,
    "op10_source_mix": source_mix,
    "op11_ball_codes": ball_codes,
    "op12_byte_bpe": byte_bpe,
    "op13_middle_fill": middle_fill,
}


def queries() -> dict:
    return {name: module.query for name, module in MODULES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: module.ORACLE_SQL for name, module in MODULES.items() if getattr(module, "ORACLE_SQL", None)}
