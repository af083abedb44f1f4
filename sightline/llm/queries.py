"""The training-data queries and, where SQL can express them, their oracles."""

from __future__ import annotations

from . import decontaminate, html_text, line_dedup, mixing, near_dup, quality, stages, suffix_dedup, token_counts, url_filters, warc

QUERIES = {
    "pipeline": stages.run,
    "op1_token_counts": token_counts.op1_query,
    "op2_quality_rules": quality.op2_query,
    "op3_decontamination": decontaminate.op3_query,
    "op4_suffix_dedup": suffix_dedup.op4_query,
    "op5_near_dup": near_dup.op5_query,
    "op6_url_filters": url_filters.op6_query,
    "op7_warc": warc.op7_query,
    "op8_line_dedup": line_dedup.op8_query,
    "op9_mixing": mixing.op9_query,
    "op10_html_text": html_text.op10_query,
}

ORACLES = {
    "op3_decontamination": decontaminate.op3_sql(),
    "op4_suffix_dedup": suffix_dedup.op4_sql(),
    "op10_html_text": html_text.op10_sql(),
    "op2_quality_rules": quality.op2_sql(),
    "op5_near_dup": near_dup.op5_sql(),
    "op6_url_filters": url_filters.op6_sql(),
    "op7_warc": warc.op7_sql(),
    "op9_mixing": mixing.op9_sql(),
}
