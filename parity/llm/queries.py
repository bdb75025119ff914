"""Registered queries of the operators, and DuckDB statements where SQL can
express them.  A query without one is tested against a brute-force version."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from parity.llm import (op01_quality_lines, op02_toxicity, op03_jaccard_join, op04_packing, op05_nearest,
                        op06_licences, op07_token_files, op08_bpe, op09_context_tree,
                        op10_secrets, op11_divergence, op12_language, op13_spelling)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_lines": op01_quality_lines.query,
    "op2_toxicity": op02_toxicity.query,
    "op3_jaccard_join": op03_jaccard_join.query,
    "op4_packing": op04_packing.query,
    "op5_nearest": op05_nearest.query,
    "op6_licences": op06_licences.query,
    "op7_token_files": op07_token_files.query,
    "op8_bpe": op08_bpe.query,
    "op9_context_tree": op09_context_tree.query,
    "op10_secrets": op10_secrets.query,
    "op11_divergence": op11_divergence.query,
    "op12_language": op12_language.query,
    "op13_spelling": op13_spelling.query,
}

ORACLE: dict[str, str] = {
    "op1_quality_lines": op01_quality_lines.SQL,
    "op3_jaccard_join": op03_jaccard_join.SQL,
    "op5_nearest": op05_nearest.SQL,
    "op6_licences": op06_licences.SQL,
    "op11_divergence": op11_divergence.SQL,
}
