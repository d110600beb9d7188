"""The corpus pipeline: five stages over ``documents``, each written and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wardflow.llm import stages
from wardflow.llm.common import table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", stages.quality_rules),
    ("near_dedup", stages.near_dedup),
    ("decontamination", stages.decontamination),
    ("secret_scan", stages.secret_scan),
    ("bpe_encode", stages.bpe_encode),
]

#: No stage can be said in SQL; the tests hold the pipeline against brute-force stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table ``documents``; returns what the last one returns."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
