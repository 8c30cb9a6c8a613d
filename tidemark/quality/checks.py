"""Data-quality checks. Each measures with one lazy aggregate and fails by raising."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import NOT_NULL, PRICES_FEED, UNIQUE_KEYS
from tidemark.session import configure
from tidemark.sources.bronze import bronze_exists

PRICE_COLUMNS = ["open_price", "high_price", "low_price", "close_price"]

# Wording that jobs and alerts look for.
NO_DATA = "No bronze data found in {path}"
STALE = "Latest bronze data ({latest}) is {days} days stale, at most {limit} allowed"
FRESH = "Freshness OK: latest ingest {latest} ({days} days old)"


class QualityError(ValueError):
    """A data-quality check failed."""


def not_null(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Rows (check, table, column, failures, passed): NULLs per column, all in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    results = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("failures")) for c in columns])
    return _report(counts.select(F.inline(results)), "not_null", table)


def unique_combination(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """One row (check, table, column, failures, passed): how many keys occur more than once."""
    repeated = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    failures = repeated.agg(F.count(F.lit(1)).alias("failures"))
    return _report(
        failures.withColumn("column", F.lit(",".join(columns))), "unique_combination", table
    )


def _report(measured: DataFrame, check: str, table: str) -> DataFrame:
    return measured.select(
        F.lit(check).alias("check"),
        F.lit(table).alias("table"),
        "column",
        "failures",
        (F.col("failures") == 0).alias("passed"),
    )


def column_tests(df: DataFrame, table: str) -> list[DataFrame]:
    """The declared not-null and uniqueness tests of a table."""
    tests = []
    if table in NOT_NULL:
        tests.append(not_null(df, table, NOT_NULL[table]))
    if table in UNIQUE_KEYS:
        tests.append(unique_combination(df, table, UNIQUE_KEYS[table]))
    return tests


def check_table(df: DataFrame, table: str) -> None:
    """Run a table's declared tests; raise on the first that fails."""
    for test in column_tests(df, table):
        failed = test.filter(~F.col("passed")).first()
        if failed is not None:
            raise QualityError(
                f"{failed['check']} failed on {table}({failed['column']}): "
                f"{failed['failures']} failures"
            )


def freshness(bronze: DataFrame, as_of: Column, max_days_stale: int) -> DataFrame:
    """One row: latest ingestion day, its age in days, and whether that is acceptable."""
    latest = bronze.agg(F.max(F.col("ingested_at").cast("timestamp").cast("date")).alias("latest"))
    stale = F.datediff(as_of, F.col("latest"))
    return latest.select(
        F.col("latest").alias("latest_ingest"),
        stale.alias("days_stale"),
        F.coalesce(stale <= max_days_stale, F.lit(False)).alias("passed"),
    )


def latest_ticker_count(prices: DataFrame) -> DataFrame:
    """One row: how many tickers have a price on the latest trade date."""
    latest = prices.agg(F.max("trade_date")).scalar()
    return prices.filter(F.col("trade_date") == latest).agg(
        F.count_distinct("ticker").alias("ticker_count")
    )


def negative_prices(prices: DataFrame) -> DataFrame:
    """One row: how many rows hold a negative price."""
    below_zero = [F.col(column) < 0 for column in PRICE_COLUMNS]
    return prices.filter(reduce(Column.__or__, below_zero)).agg(F.count(F.lit(1)).alias("negative_count"))


def check_report(
    bronze: DataFrame,
    prices: DataFrame,
    as_of: Column,
    max_days_stale: int = 3,
    expected_tickers: tuple[int, int] = (2, 20),
) -> DataFrame:
    """Rows (check, measured, passed): all table checks, measured without raising."""
    fewest, most = expected_tickers
    measured = {
        "freshness": freshness(bronze, as_of, max_days_stale).select(
            F.col("days_stale").cast("bigint").alias("measured"), "passed"
        ),
        "ticker_count": latest_ticker_count(prices).select(
            F.col("ticker_count").alias("measured"),
            F.col("ticker_count").between(fewest, most).alias("passed"),
        ),
        "negative_prices": negative_prices(prices).select(
            F.col("negative_count").alias("measured"),
            (F.col("negative_count") == 0).alias("passed"),
        ),
    }
    rows = [df.select(F.lit(name).alias("check"), "*") for name, df in measured.items()]
    return reduce(DataFrame.unionByName, rows)


def check_bronze_freshness(
    spark: SparkSession,
    bronze: str = "data/bronze",
    max_days_stale: int = 3,
    as_of: date | None = None,
) -> str:
    """Fail if there is no price data or the latest is older than allowed."""
    configure(spark)
    if not bronze_exists(spark, bronze, PRICES_FEED):
        raise QualityError(NO_DATA.format(path=bronze))
    rows = spark.read.parquet(f"{bronze}/{PRICES_FEED.table}").select("ingested_at")
    found = freshness(rows, F.lit(as_of or date.today()), max_days_stale).first()
    latest, days = found["latest_ingest"], found["days_stale"]
    if latest is None:
        raise QualityError("Bronze data carries no ingestion date")
    if not found["passed"]:
        raise QualityError(STALE.format(latest=latest, days=days, limit=max_days_stale))
    return FRESH.format(latest=latest, days=days)


def check_ticker_count(prices: DataFrame, expected_min: int = 2, expected_max: int = 20) -> str:
    """Fail unless the latest day has a plausible number of tickers (bounds inclusive)."""
    count = latest_ticker_count(prices).first()["ticker_count"]
    if not expected_min <= count <= expected_max:
        raise QualityError(
            f"{count} tickers on the latest trade date, expected {expected_min} to {expected_max}"
        )
    return f"Volume OK: {count} tickers on the latest trade date"


def check_no_negative_prices(prices: DataFrame) -> str:
    count = negative_prices(prices).first()["negative_count"]
    if count > 0:
        raise QualityError(f"{count} rows hold a negative price")
    return "Prices OK: none is negative"


def run_checks(
    spark: SparkSession,
    bronze: str,
    prices: DataFrame,
    max_days_stale: int = 3,
    expected_tickers: tuple[int, int] = (2, 20),
    as_of: date | None = None,
) -> list[str]:
    """Freshness, volume, sanity, in this order; the first failure stops the suite."""
    return [
        check_bronze_freshness(spark, bronze, max_days_stale, as_of),
        check_ticker_count(prices, *expected_tickers),
        check_no_negative_prices(prices),
    ]
