"""A corpus pipeline: toxicity, near duplicates, repeated strings, benchmark passages, then tokens.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import stages
from tidemark.llm.common import staged, table


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go."""
    return stages.without_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays (five words, similarity 0.8)."""
    return stages.without_near_duplicates(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 200 bytes that stand elsewhere too are cut out of the texts."""
    return stages.without_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    return stages.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every text that is left, encoded and decoded again."""
    return stages.encoded(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("suffix_dedup", suffix_dedup),
    ("decontamination", decontamination),
    ("byte_bpe", byte_bpe),
]

#: A trained model and byte-level decisions are beyond SQL; the tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared scratch folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
