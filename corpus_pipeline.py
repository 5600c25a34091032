"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.llm import stages  # noqa: E402
from tidemark.session import fresh_dir  # noqa: E402

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", stages.keep_quality),
    ("ngram_jaccard_join", stages.keep_one_of_group),
    ("benchmark_decontamination", stages.keep_uncontaminated),
    ("mixing", stages.mix_sources),
    ("token_output", stages.encode_tokens),
]

#: Trained scores and tokenizer ids cannot be written in SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents``; returns what the last one returns."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = fresh_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
