"""Streaming from staged responses into bronze."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from tidemark.schemas import Feed
from tidemark.sources.bronze import LandingReport, apply_failure_policy, land, staged_responses


def stream_staged(
    spark: SparkSession, path: str, feed: Feed, max_files_per_trigger: int | None = None
) -> DataFrame:
    """A stream of the responses that ``read_staged`` reads, as their files arrive."""
    reader = spark.readStream.schema("value string").option("pathGlobFilter", "*.json")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return staged_responses(reader.text(path, wholetext=True), feed)


def stream_landing(
    responses: DataFrame, bronze: str, feed: Feed, checkpoint: str, ingested_at: datetime | None = None
) -> LandingReport:
    """Land every response that has arrived, batch by batch, then apply the failure policy to all.

    ``responses``: a stream of (key, raw_payload). Each batch writes its usable responses to bronze
    and sets the others aside; both are counted as the batch is written. A batch that is repeated
    after a failure finds what it has landed before, so nothing lands twice. As when landing in one
    go, what is usable stays landed if the policy then raises.
    """
    reports: dict[int, LandingReport] = {}

    def land_batch(batch: DataFrame, number: int) -> None:
        kept = batch.persist()  # two writes, and the source is read once
        reports[number] = land(kept, bronze, feed, ingested_at, once=True, policy=False)
        kept.unpersist()

    _run(responses, checkpoint, land_batch)
    total = LandingReport(sum(r.landed for r in reports.values()), sum(r.rejected for r in reports.values()))
    apply_failure_policy(total, feed)
    return total


def _run(rows: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None]) -> None:
    writer = rows.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()
