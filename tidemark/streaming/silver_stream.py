"""Streaming bronze to silver: files are merged as they land."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.plans.refresh import SilverTable, merge_bronze
from tidemark.session import configure
from tidemark.sources.bronze import PARTITION_PATTERN, by_schema, read_files
from tidemark.sources.tables import Warehouse


def stream_silver(
    spark: SparkSession,
    bronze: str,
    table: SilverTable,
    warehouse: Warehouse,
    checkpoint: str,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Process every bronze file not yet seen, then stop.

    Each micro-batch goes through the same merge as the batch refresh. That merge is idempotent,
    so a batch repeated after a failure has no further effect, and the result does not depend on
    the order of files; no watermark is used, so no late row is ever dropped.

    The stream carries the names of files; a batch reads its files by schema, as the batch scan does,
    so payloads may be text or structs of any kind. Without ``max_files_per_trigger`` one batch takes
    all new files.
    """

    configure(spark)
    folder = f"{bronze}/{table.feed.table}"

    def merge(batch: DataFrame, _batch_id: int) -> None:
        session = batch.sparkSession
        below = F.regexp_extract("path", f"({PARTITION_PATTERN}.*)$", 1)
        files = sorted(row[0] for row in batch.select(below).collect() if row[0])
        rows = read_files(session, folder, table.feed, by_schema(session, folder, files))
        merge_bronze(rows, table, warehouse)

    # Without its content column no file is opened by the source.
    listed = "path string, modificationTime timestamp, length long, content binary"
    reader = spark.readStream.format("binaryFile").schema(listed).option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return (
        reader.load(folder)
        .select("path")
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
