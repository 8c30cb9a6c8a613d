"""Small questions to the file system that holds the tables, whichever Hadoop file system it is."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def exists(spark: SparkSession, path: str) -> bool:
    system, location = _located(spark, path)
    return system.exists(location)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; none if it does not exist."""
    system, location = _located(spark, path)
    if not system.exists(location):
        return []
    return [status.getPath().getName() for status in system.listStatus(location)]


def mark(spark: SparkSession, path: str) -> None:
    """Create an empty file."""
    system, location = _located(spark, path)
    system.create(location, True).close()


def unmark(spark: SparkSession, path: str) -> None:
    """Remove a file made by ``mark``."""
    system, location = _located(spark, path)
    system.delete(location, False)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder of a table with all it holds."""
    system, location = _located(spark, path)
    system.delete(location, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file so that it appears whole or not at all."""
    system, location = _located(spark, path)
    begun = location.suffix(".tmp")
    stream = system.create(begun, True)
    stream.write(text.encode())
    stream.close()
    system.delete(location, False)
    if not system.rename(begun, location):
        raise OSError(f"{path} could not be written")


def read_text(spark: SparkSession, path: str) -> str:
    """The contents of a small file."""
    system, location = _located(spark, path)
    stream = system.open(location)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
