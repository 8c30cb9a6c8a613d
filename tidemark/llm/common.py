"""What the operators of this folder share: the two columns they read, and stored intermediate tables."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import CLEANUP, configure, shared_dir, shuffles_removed  # noqa: F401

_shipped: set[str] = set()

WORD_GAP = r"[ \t\n\x0B\f\r]+"  # what lies between words, as a Java pattern


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/documents.parquet")


def ship(spark: SparkSession) -> None:
    """Give the workers this library, once per application: they need not have it installed."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        library = Path(__file__).resolve().parents[1]
        folder = tempfile.mkdtemp(prefix="tidemark-")
        context.addPyFile(shutil.make_archive(f"{folder}/tidemark_library", "zip", library.parent, library.name))
        _shipped.add(context.applicationId)


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id long, text string): other columns go, so their names cannot clash; a null text is empty."""
    return docs.select(
        docs[id_col].cast("long").alias("doc_id"),
        F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"),
    )


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own below the one all executors share."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write and read back: cuts the lineage, survives lost executors, and keeps column pruning.

    What the query shuffled is in the table then, so its shuffle files go at once.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    with shuffles_removed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` in order."""
    return F.array_remove(F.split(text, WORD_GAP), "")
