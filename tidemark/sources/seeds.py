"""Seed tables: header CSV files with a fixed schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.schemas import COMPANY_SEED


def read_seed(spark: SparkSession, path: str, schema: T.StructType = COMPANY_SEED) -> DataFrame:
    return (
        spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)
    )
