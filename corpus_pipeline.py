"""The corpus pipeline: stages that each call one operator of tidemark.llm on what the last one kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import documents, stored
from tidemark.llm.exact_dedup import drop_copies
from tidemark.llm.packing import pack
from tidemark.llm.quality_rules import keep_good
from tidemark.llm.simhash import drop_near
from tidemark.llm.suffix_dedup import drop_repeats


REPEAT_BYTES = 250  # repeated strings that go: 50 words of four letters and a space


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return keep_good(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id stays."""
    return drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by near fingerprints the one with the smallest doc_id stays."""
    return drop_near(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of some 50 words that stand in several places go; n_chars follows the text."""
    return drop_repeats(docs, REPEAT_BYTES).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens and their places in training sequences."""
    return pack(docs)


STAGES = [
    ("quality_rules", quality),
    ("exact_dedup", exact),
    ("simhash_near_dedup", near),
    ("suffix_array_dedup", repeats),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again by the next."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


ORACLE_SQL = None  # SimHash needs a hash that SQL lacks, packing a solver
