"""Queries of this subpackage by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from . import bpe_codec, decontaminate, line_dedup, neardup, shards, substring_dedup, token_counts, token_files, topk, toxicity

QUERIES = {
    "op1_near_duplicates": neardup.query,
    "op2_bpe_codec": bpe_codec.query,
    "op3_shards": shards.query,
    "op4_topk": topk.query,
    "op5_toxicity": toxicity.query,
    "op6_decontaminate": decontaminate.query,
    "op7_substring_dedup": substring_dedup.query,
    "op8_token_counts": token_counts.query,
    "op9_token_files": token_files.query,
    "op10_line_dedup": line_dedup.query,
}

SQL: dict[str, str] = {
    "op4_topk": topk.SQL,
    "op6_decontaminate": decontaminate.SQL,
    "op10_line_dedup": line_dedup.SQL,
}
