"""The corpus pipeline: documents to packed training sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ridemill.llm.exact_dedup import exact_dedup
from ridemill.llm.frames import written
from ridemill.llm.near_dedup import near_dedup
from ridemill.llm.packing import packed
from ridemill.llm.quality_rules import quality_filter
from ridemill.llm.substring_dedup import cut_repeats

#: Tokens, similarities and covering codes are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, without their failing lines."""
    return quality_filter(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, the one with the largest doc_id."""
    return exact_dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicates (five-word shingles, similarity of 0.8 or more), the one with the least doc_id."""
    return near_dedup(docs)


def substring(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages of 13 words and more that a smaller doc_id has too."""
    return cut_repeats(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens as pieces of sequences of 2048."""
    return packed(docs)


STAGES = [
    ("quality rules", quality),
    ("exact dedup", exact),
    ("near dedup", near),
    ("substring dedup", substring),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each stage's result is written and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
