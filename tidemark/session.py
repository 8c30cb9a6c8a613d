"""Session settings and the folder every executor can reach."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession

from tidemark.sources.files import remove

# Settings that change results, so they are applied to any session we are handed.
SEMANTICS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Settings that only change speed. Shuffle partition counts are left to the cluster: AQE
# coalesces small ones and splits skewed ones, so no number is baked in here.
TUNING = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.ui.enabled": "false",
}

#: Setting by which Spark removes the shuffle files of a query when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def configure(spark: SparkSession) -> SparkSession:
    """Pin the settings our results depend on, whoever created the session."""
    for key, value in SEMANTICS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(
    app_name: str = "tidemark", master: str | None = None, extra: Mapping[str, str] | None = None
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SEMANTICS, **TUNING, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables that must survive the loss of an executor.

    The cluster names it in ``spark.checkpoint.dir``. A temporary folder is only ever chosen in
    local mode, where driver and executors are one process on one machine.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
    return context.getCheckpointDir()


def compact(writer: DataFrameWriter) -> DataFrameWriter:
    """Files that take less disk than the session's default codec would leave them."""
    return writer.option("compression", "zstd")


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries run inside leave no shuffle files; else these stay until the driver collects its garbage."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def _written(df: DataFrame) -> tuple[DataFrame, str]:
    path = f"{shared_dir(df.sparkSession)}/tidemark/{uuid.uuid4().hex}"
    with shuffles_removed(df.sparkSession):
        compact(df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def materialized(df: DataFrame) -> DataFrame:
    """Evaluate once: write to the shared folder and read back. Survives the loss of executors."""
    return _written(df)[0]


@contextlib.contextmanager
def held(df: DataFrame) -> Iterator[DataFrame]:
    """``materialized`` while the block runs: its files go at the end, so nothing read later may come from it."""
    rows, path = _written(df)
    try:
        yield rows
    finally:
        remove(df.sparkSession, path)
