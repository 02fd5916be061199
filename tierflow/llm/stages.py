"""The stages of ``corpus_pipeline``: each takes (spark, docs, sf_dir) and returns the rows it keeps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, exact_dedup, near_dedup, packing, toxicity
from .common import read_table
from .queries import tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5; the model learns from the labels of ``docs`` that are not held out."""
    return toxicity.without_toxic(docs, toxicity.fit(docs, read_table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the longest, then the one with the smallest id."""
    return exact_dedup.without_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate class."""
    return near_dedup.without_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a copy of no benchmark item."""
    return decontaminate.without_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens in sequences; see `packing.packed`."""
    return packing.packed(docs, tokenizer_path())
