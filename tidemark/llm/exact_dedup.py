"""Exact dedup: a tree of merges over sorted runs of text digests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, id_and_text, stored

RUNS = 64  # runs at the leaves of the tree
FAN_IN = 8  # runs that one merge joins

TEXT = ["digest", "n_bytes", "check"]


def _digests(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per document. ``n_bytes`` and ``check`` verify a digest: rows merge only if all agree."""
    rows = id_and_text(docs, id_col, text_col)
    return rows.select(
        "doc_id",
        F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"),
        F.octet_length("text").alias("n_bytes"),
        F.xxhash64("text").alias("check"),
        F.monotonically_increasing_id().alias("row"),
        F.pmod(F.spark_partition_id(), F.lit(RUNS)).alias("run"),
    )


def merge_runs(rows: DataFrame) -> DataFrame:
    """(digest, n_bytes, check, keep, group_size) from rows that carry doc_id, row and run.

    The first level sums up each run by itself, so a text that fills a third of the table leaves
    one row per run. Each further round exchanges the runs of FAN_IN neighbours, dealt by digest
    as well as by run, and merges them in digest order, until one run is left.
    """
    level = rows.groupBy("run", *TEXT).agg(
        F.max(F.struct("doc_id", "row")).alias("keep"), F.count(F.lit(1)).alias("group_size")
    )
    runs = RUNS
    while runs > 1:
        runs = -(-runs // FAN_IN)
        level = (
            level.withColumn("run", (F.col("run") / FAN_IN).cast("int"))
            .repartition("run", *TEXT)
            .sortWithinPartitions("run", *TEXT)
            .groupBy("run", *TEXT)
            .agg(F.max("keep").alias("keep"), F.sum("group_size").alias("group_size"))
        )
    return level.drop("run")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: (doc_id, keep_id, group_size, kept, text_sha256).

    Of equal texts the row with the largest doc_id stays. A null text counts as empty; a null
    doc_id is smaller than any other; of rows that repeat the largest doc_id exactly one stays.
    An empty table gives no rows. Other columns are not read.
    """
    rows = stored(_digests(docs, id_col, text_col), "digests")
    kept = stored(merge_runs(rows), "kept")
    return rows.join(kept, TEXT).select(
        "doc_id",
        F.col("keep.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("keep.row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that exact_dedup keeps, with all their columns.

    Rows that repeat both doc_id and text are one document; any one of them stays.
    """
    kept = (
        exact_dedup(docs, id_col, text_col)
        .filter("kept")
        .select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha"))
    )
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    marked = docs.withColumn("__sha", F.sha2(text.cast("binary"), 256))
    same = marked["__sha"].eqNullSafe(kept["__sha"]) & marked[id_col].cast("long").eqNullSafe(kept["__id"])
    return marked.join(kept, same, "left_semi").dropDuplicates(["__sha"]).drop("__sha")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir))


OP4_SQL = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
