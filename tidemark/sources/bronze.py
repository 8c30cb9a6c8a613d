"""Bronze: staged response files -> validated, append-only landings -> drift-tolerant scans."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.payload import first_text, has_key, payload_text
from tidemark.schemas import UNKNOWN_ERROR, Feed
from tidemark.session import compact
from tidemark.sources.files import children, exists, read_text, write_text

# How a partition date is spelled in a file path, how a rejection begins.
PARTITION_PATTERN = "ingest_date=([0-9-]+)"
REJECTION = "Unexpected response for "

SCHEMA_READERS = 8  # days whose schemas are read at the same time
SCHEMAS_AT_ONCE = 32  # schemas that one job turns into text


class IngestionError(Exception):
    """A landing run failed under its feed's failure policy."""


@dataclass(frozen=True)
class LandingReport:
    landed: int
    rejected: int


def read_staged(spark: SparkSession, path: str, feed: Feed) -> DataFrame:
    """Responses staged as one JSON file each, named after their ticker or series.

    A name may carry a time after an underscore (``AAPL_221500.json``).
    """
    return staged_responses(spark.read.option("pathGlobFilter", "*.json").text(path, wholetext=True), feed)


def staged_responses(files: DataFrame, feed: Feed) -> DataFrame:
    """(key, payload) of staged files, in a batch or a stream."""
    name = F.regexp_extract(F.col("_metadata.file_name"), r"^(.+?)(?:_\d+)?\.json$", 1)
    return files.select(name.alias(feed.key), F.col("value").alias("raw_payload"))


def envelope_error(payload: Column, key: Column, feed: Feed) -> Column:
    """NULL for a usable response, else the reason it is rejected."""
    reason = F.coalesce(first_text(payload, *feed.error_fields), F.lit(UNKNOWN_ERROR))
    message = F.concat(F.lit(REJECTION), F.coalesce(key, F.lit("")), F.lit(": "), reason)
    return F.when(~has_key(payload, feed.required), message)


def with_envelope_error(responses: DataFrame, feed: Feed) -> DataFrame:
    return responses.withColumn(
        "error", envelope_error(F.col("raw_payload"), F.col(feed.key), feed)
    )


def bronze_rows(responses: DataFrame, feed: Feed, ingested_at: datetime) -> DataFrame:
    """Stamp responses with their landing metadata; the payload itself is never touched."""
    moment = ingested_at.astimezone(timezone.utc)
    stamped = responses.withColumn("ingested_at", F.lit(moment.isoformat())).withColumn(
        "source", F.lit(feed.source)
    )
    if feed.api_function:
        stamped = stamped.withColumn("api_function", F.lit(feed.api_function))
    return stamped.select(*feed.columns, F.lit(moment.date()).alias("ingest_date"))


def append_bronze(rows: DataFrame, bronze: str, feed: Feed, by_day: bool = False) -> None:
    """Append rows to the feed's table, partitioned by ingestion date.

    The rebalance hint sizes the files: AQE merges small partitions and splits a day that is
    large, so neither a thousand tiny files nor one huge one is written per day.

    ``by_day``: every partition of ``rows`` is large and sorted by ingestion date already, before its
    payloads were rendered. It is written where it is, one file per partition and day: text, several
    times as large as what it was rendered from, is neither sorted nor shuffled.
    """
    placed = rows if by_day else rows.hint("rebalance", F.col("ingest_date"))
    compact(placed.write).mode("append").partitionBy("ingest_date").parquet(f"{bronze}/{feed.table}")


def _digest() -> Column:
    return F.coalesce(F.sha2("raw_payload", 256), F.lit(""))


def _not_among(responses: DataFrame, stored: DataFrame, feed: Feed) -> DataFrame:
    """Responses whose content is not stored for their key. Only digests of one day are compared."""
    known = stored.select(F.col(feed.key).alias("_key"), _digest().alias("_digest")).distinct()
    same = F.col(feed.key).eqNullSafe(F.col("_key")) & (_digest() == F.col("_digest"))
    return responses.join(known, same, "left_anti")


def land(
    responses: DataFrame,
    bronze: str,
    feed: Feed,
    ingested_at: datetime | None = None,
    once: bool = False,
    policy: bool = True,
) -> LandingReport:
    """Append usable responses to bronze, set the others aside, then apply the failure policy.

    Outcomes are counted while the good rows are written; the responses are read again only if
    there is something to set aside.

    ``once``: responses whose content has been landed, or set aside, for their key on the day of
    ``ingested_at`` are left out, so a batch that is tried again, after whatever part of it was
    written, ends up there once; the report still counts all its responses. A batch that repeats a
    response by itself keeps the repeats. ``policy``: False leaves the policy to the caller.
    """
    spark = responses.sparkSession
    stamp = (ingested_at or datetime.now(timezone.utc)).astimezone(timezone.utc)
    outcome = Observation()
    failed = F.col("error").isNotNull()
    checked = with_envelope_error(responses, feed)
    counted = checked.observe(
        outcome, F.count_if(~failed).alias("landed"), F.count_if(failed).alias("rejected")
    )
    good, bad = counted.filter(~failed), checked.filter(failed)
    if once and exists(spark, f"{bronze}/{feed.table}"):
        today = read_bronze(spark, bronze, feed).filter(F.col("ingest_date") == F.lit(stamp.date()))
        good = _not_among(good, today, feed)
    append_bronze(bronze_rows(good, feed, stamp), bronze, feed)
    report = LandingReport(**outcome.get)
    if report.rejected:
        if once and exists(spark, f"{bronze}/_rejected/{feed.table}"):
            today = read_rejected(spark, bronze, feed).filter(F.col("ingested_at").startswith(stamp.date().isoformat()))
            bad = _not_among(bad, today, feed)
        rejected = bad.withColumn("ingested_at", F.lit(stamp.isoformat()))
        rejected.select(feed.key, "raw_payload", "error", "ingested_at").write.mode(
            "append"
        ).parquet(f"{bronze}/_rejected/{feed.table}")
    if policy:
        apply_failure_policy(report, feed)
    return report


def apply_failure_policy(report: LandingReport, feed: Feed) -> None:
    """Raise if the feed does not tolerate the failures that occurred."""
    if not report.rejected:
        return
    if feed.failure_policy == "any":
        raise IngestionError(f"{report.rejected} responses failed to ingest into {feed.table}")
    if not report.landed:
        raise IngestionError(f"All {report.rejected} responses failed to ingest into {feed.table}")


def read_rejected(spark: SparkSession, bronze: str, feed: Feed) -> DataFrame:
    return spark.read.parquet(f"{bronze}/_rejected/{feed.table}")


def read_bronze(spark: SparkSession, bronze: str, feed: Feed) -> DataFrame:
    """Scan the whole feed with its partition column, in one pass over all ingestion days.

    Payloads landed here are text, so the schema is the same on every day.
    """
    return spark.read.schema(feed.schema).parquet(f"{bronze}/{feed.table}")


def bronze_files(spark: SparkSession, bronze: str, feed: Feed) -> list[str]:
    """Files of the feed's dated folders, by their path below the feed's table."""
    if not exists(spark, f"{bronze}/{feed.table}"):
        return []
    found = _parquet_files(spark, f"{bronze}/{feed.table}").filter(F.col("path").rlike(PARTITION_PATTERN))
    below = F.regexp_extract("path", f"({PARTITION_PATTERN}.*)$", 1)
    return sorted(row[0] for row in found.select(below).collect())


def _schemas(spark: SparkSession, table: str, files: list[str]) -> list[tuple[T.StructType, list[str]]]:
    """The files with their common schema, or each with its own where they have none in common."""
    try:
        reader = spark.read.option("mergeSchema", True).option("basePath", table)
        return [(reader.parquet(*[f"{table}/{file}" for file in files]).schema, files)]
    except (PySparkException, Py4JJavaError):  # schemas that cannot be merged
        if len(files) == 1:
            raise
        return [found for file in files for found in _schemas(spark, table, [file])]


def by_schema(spark: SparkSession, table: str, files: Sequence[str]) -> list[tuple[T.StructType, list[str]]]:
    """Files grouped by schema. The schemas of several days are read at the same time."""
    days: dict[str, list[str]] = {}
    for file in files:
        days.setdefault(file.rpartition("/")[0], []).append(file)
    with ThreadPoolExecutor(SCHEMA_READERS) as readers:
        found = readers.map(lambda day: _schemas(spark, table, day), days.values())
        groups: dict[str, tuple[T.StructType, list[str]]] = {}
        for schema, own in (pair for pairs in found for pair in pairs):
            groups.setdefault(schema.json(), (schema, []))[1].extend(own)
    return list(groups.values())


def _is_text(schema: T.StructType) -> bool:
    return isinstance(schema["raw_payload"].dataType, T.StringType)


def read_files(spark: SparkSession, table: str, feed: Feed, groups: Sequence[tuple[T.StructType, list[str]]]) -> DataFrame:
    """Rows of grouped files with their payload as text: one scan per schema.

    ``to_json`` leaves out fields that are NULL, so each row gets exactly the keys it was landed with.
    """
    if not groups:
        return spark.createDataFrame([], feed.schema)
    parts = []
    for schema, files in groups:
        rows = spark.read.schema(schema).option("basePath", table).parquet(*[f"{table}/{file}" for file in files])
        text = rows.withColumn("raw_payload", payload_text(rows))
        known = [F.col(f.name) if f.name in schema.names else F.lit(None).alias(f.name) for f in feed.schema]
        parts.append(text.select(*[c.cast(f.dataType).alias(f.name) for c, f in zip(known, feed.schema)]))
    return reduce(DataFrame.unionByName, parts)


def read_any_bronze(spark: SparkSession, bronze: str, feed: Feed, root: str) -> DataFrame:
    """Scan a feed whose payloads are text, or structs that differ from file to file, or both.

    Which files are known to hold text is noted below ``root``. Structs are turned into text there
    once, one scan per schema, some schemas at a time; a batch counts when its note is written. So a
    scan looks at the schemas of new files only, whatever day they belong to, and has one branch for
    text and one for former structs, however many schemas there are. A feed without structs is read
    as it is.
    """
    table, target = f"{bronze}/{feed.table}", f"{root}/_text_bronze/{feed.table}"
    files = bronze_files(spark, bronze, feed)
    noted = [json.loads(read_text(spark, f"{target}/noted/{n}")) for n in children(spark, f"{target}/noted")]
    known = {file for note in noted for file in note["files"]}
    groups = by_schema(spark, table, [file for file in files if file not in known])
    structs = [group for group in groups if not _is_text(group[0])]
    batches = [structs[i : i + SCHEMAS_AT_ONCE] for i in range(0, len(structs), SCHEMAS_AT_ONCE)]
    for batch in [[group for group in groups if _is_text(group[0])], *batches]:
        if batch:
            note = {"files": [file for _, own in batch for file in own], "folder": None}
            if not _is_text(batch[0][0]):
                note["folder"] = f"batch-{uuid.uuid4().hex}"
                converted = read_files(spark, table, feed, batch).hint("rebalance", F.col("ingest_date"))
                compact(converted.write).partitionBy("ingest_date").parquet(f"{target}/{note['folder']}")
            write_text(spark, f"{target}/noted/{uuid.uuid4().hex}.json", json.dumps(note))
            noted.append(note)
    folders = [note["folder"] for note in noted if note["folder"]]
    if not folders:
        return read_bronze(spark, bronze, feed)
    texts = sorted({file for note in noted if not note["folder"] for file in note["files"]} & set(files))
    rows = reduce(DataFrame.unionByName, [spark.read.schema(feed.schema).parquet(f"{target}/{f}") for f in folders])
    return rows.unionByName(read_files(spark, table, feed, [(feed.schema, texts)])) if texts else rows


def _parquet_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per Parquet file below ``path``; without its content column no file is opened."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path")
    )


def list_partitions(spark: SparkSession, path: str) -> DataFrame:
    """Sorted distinct ingestion dates among the Parquet files below ``path``.

    Files outside a dated folder are ignored.
    """
    dated = _parquet_files(spark, path).filter(F.col("path").rlike(PARTITION_PATTERN))
    return (
        dated.select(F.regexp_extract("path", PARTITION_PATTERN, 1).alias("ingest_date"))
        .distinct()
        .orderBy("ingest_date")
    )


def bronze_exists(spark: SparkSession, bronze: str, feed: Feed) -> bool:
    """Whether any Parquet file was ever landed for the feed."""
    path = f"{bronze}/{feed.table}"
    return exists(spark, path) and not _parquet_files(spark, path).isEmpty()
