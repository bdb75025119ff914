"""Cleaning a corpus for training, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next one's ``docs``.  All stages but the last
return the columns of ``docs``.

1. toxicity        documents predicted toxic go
2. quality_rules   documents that fail the base rules or are depleted go
3. jaccard_join    of each component of near-duplicates the smallest doc_id stays
4. secret_scans    secrets are masked in the text (n_chars follows)
5. packing         what is left, as pieces of 4096-token sequences

Nulls, empty texts, repeated rows, extra columns and empty tables are treated
as each operator's docstring says; columns beyond doc_id, text, source and
n_chars are carried along untouched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from parity.llm import (common, op01_quality_lines, op02_toxicity, op03_jaccard_join, op04_packing,
                        op10_secrets)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op02_toxicity.keep_clean(docs, common.read(spark, sf_dir, "labels"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op01_quality_lines.keep_good(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op03_jaccard_join.keep_one(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op10_secrets.redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return op04_packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2)


STAGES = [("toxicity", toxicity), ("quality_rules", quality_rules), ("jaccard_join", jaccard_join),
          ("secret_scans", secret_scans), ("packing", packing)]

#: SQL can express neither the machine nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
