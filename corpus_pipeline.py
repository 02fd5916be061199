"""Cleans a corpus and packs it into training sequences: five stages over ``documents``."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from tierflow import storage
from tierflow.llm import stages

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", stages.drop_toxic),
    ("exact_dedup", stages.drop_copies),
    ("near_dedup", stages.drop_near_copies),
    ("decontamination", stages.drop_contaminated),
    ("packing", stages.pack),
]

# The first stage fits a classifier, which SQL cannot express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each writes Parquet in the shared folder, which the next one reads.

    What a stage stages for itself is deleted as soon as its result is written.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = storage.stage_result(spark, partial(stage, spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
