"""Queries of the llm operators and their SQL twins, where SQL can express them."""

from __future__ import annotations

import corpus_pipeline
from tidewell.llm import chat_format, decontaminate, html_text, license_scan, line_dedup, near_dedup, nearest, packing, progressive_jpeg, spelling, substring_dedup, toxicity, whitening

_MODULES = {"op1_packing": packing, "op2_decontaminate": decontaminate, "op3_chat_format": chat_format, "op4_toxicity": toxicity, "op5_near_dedup": near_dedup, "op6_html_text": html_text, "op7_progressive_jpeg": progressive_jpeg, "op8_license_scan": license_scan, "op9_line_dedup": line_dedup, "op10_substring_dedup": substring_dedup, "op11_spelling_variants": spelling, "op12_nearest": nearest, "op13_whitening": whitening}


def queries():
    found = {name: getattr(module, name) for name, module in _MODULES.items()}
    return found | {"pipeline": corpus_pipeline.run}


def oracle_sql():
    found = {name: module.ORACLE_SQL for name, module in _MODULES.items() if getattr(module, "ORACLE_SQL", None)}
    return found | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
