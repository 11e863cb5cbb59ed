"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from importlib import import_module

#: Query name to module.
MODULES = {
    "op1_quality_rules": "quality_rules",
    "op2_embedding_dedup": "embedding_dedup",
    "op3_secrets": "secrets",
    "op4_packing": "packing",
    "op5_quality_classifier": "quality_classifier",
    "op6_suffix_dedup": "suffix_dedup",
    "op7_html_text": "html_text",
    "op8_weighted_minhash": "weighted_minhash",
    "op9_byte_bpe": "byte_bpe",
    "op10_language_id": "language_id",
    "op11_line_dedup": "line_dedup",
    "op12_importance_resampling": "importance_resampling",
}


def queries():
    return {name: import_module(f"tessera.llm.{module}").query for name, module in MODULES.items()}


def oracle_sql():
    found = {name: getattr(import_module(f"tessera.llm.{module}"), "ORACLE", None) for name, module in MODULES.items()}
    return {name: sql for name, sql in found.items() if sql}
