"""Synthetic bronze data of any size, in the shape of the real feeds.

Run as a job: ``python -m tidemark.sources.samples --output-root DIR [--ingest-date YYYY-MM-DD]``.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import (
    MACRO_FEED,
    OBSERVATIONS_KEY,
    PRICE_BAR_FIELDS,
    PRICE_SERIES_KEY,
    PRICES_FEED,
)
from tidemark.session import build_session
from tidemark.sources.bronze import append_bronze

# --- Fixed values of the sample data -----------------------------------------------------------
SAMPLE_TICKERS = ["AAPL", "MSFT", "GOOGL"]
SAMPLE_FIRST_DAY = date(2026, 8, 20)
SAMPLE_DAYS = 10
FIRST_OPEN, OPEN_STEP, SPREAD, CLOSE_GAIN = 150.0, 2, 2, 1
FIRST_VOLUME, VOLUME_STEP = 1_000_000, 10_000
SAMPLE_INFORMATION = "Daily Prices"
SAMPLE_OBSERVATIONS = {
    "CPIAUCSL": [("2026-01-01", "300.0"), ("2026-02-01", "301.0"), ("2026-03-01", "302.0")],
    "UNRATE": [("2026-01-01", "3.8"), ("2026-02-01", "3.7"), ("2026-03-01", "3.9")],
    "FEDFUNDS": [("2026-01-01", "5.25"), ("2026-02-01", "5.25"), ("2026-03-01", "5.5")],
    "GDP": [("2026-01-01", "27000.0"), ("2026-04-01", "27500.0")],
}
# -----------------------------------------------------------------------------------------------


def _stamp(rows: DataFrame, feed, ingest_date: date) -> DataFrame:
    stamped = rows.withColumns(
        {
            "ingested_at": F.lit(f"{ingest_date.isoformat()}T00:00:00"),
            "source": F.lit(feed.source),
            "ingest_date": F.lit(ingest_date),
        }
    )
    if feed.api_function:
        stamped = stamped.withColumn("api_function", F.lit(feed.api_function))
    return stamped.select(*feed.columns, "ingest_date")


def sample_prices(
    spark: SparkSession,
    ingest_date: date | None = None,
    tickers: Sequence[str] | int = SAMPLE_TICKERS,
    days: int = SAMPLE_DAYS,
) -> DataFrame:
    """One response per ticker with ``days`` rising bars; an int asks for that many tickers.

    Each payload is built inside its row from a sequence of days, so the number of tickers scales
    with the partitions of ``spark.range`` and nothing is grouped.
    """
    if isinstance(tickers, int):
        named = spark.range(tickers).select(
            F.concat(F.lit("T"), F.col("id").cast("string")).alias("ticker")
        )
    else:
        named = spark.createDataFrame([(t,) for t in tickers], "ticker string")

    def bar(i):
        base = F.lit(FIRST_OPEN) + i * OPEN_STEP
        volume = F.lit(FIRST_VOLUME) + i * VOLUME_STEP
        values = [base, base + SPREAD, base - SPREAD, base + CLOSE_GAIN, volume]
        named_values = zip(PRICE_BAR_FIELDS.values(), values, strict=True)
        return F.struct(*[value.cast("string").alias(field) for field, value in named_values])

    def entry(i):
        return F.struct(F.date_add(F.lit(SAMPLE_FIRST_DAY), i).cast("string"), bar(i))

    series = F.map_from_entries(F.transform(F.sequence(F.lit(0), F.lit(days - 1)), entry))
    meta = F.struct(
        F.lit(SAMPLE_INFORMATION).alias("1. Information"), F.col("ticker").alias("2. Symbol")
    )
    payload = F.struct(meta.alias("Meta Data"), series.alias(PRICE_SERIES_KEY))
    return _stamp(
        named.withColumn("raw_payload", F.to_json(payload)), PRICES_FEED, ingest_date or date.today()
    )


def sample_macro(spark: SparkSession, ingest_date: date | None = None) -> DataFrame:
    """One response per series with its monthly or quarterly observations."""
    rows = [
        (series, [{"date": day, "value": value} for day, value in points])
        for series, points in SAMPLE_OBSERVATIONS.items()
    ]
    listed = spark.createDataFrame(
        rows, f"series_id string, {OBSERVATIONS_KEY} array<struct<date:string,value:string>>"
    )
    payload = F.to_json(F.struct(OBSERVATIONS_KEY))
    return _stamp(
        listed.withColumn("raw_payload", payload), MACRO_FEED, ingest_date or date.today()
    )


def write_samples(
    spark: SparkSession, output_root: str, ingest_date: date | None = None
) -> None:
    append_bronze(sample_prices(spark, ingest_date), output_root, PRICES_FEED)
    append_bronze(sample_macro(spark, ingest_date), output_root, MACRO_FEED)


def main(argv: Sequence[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description="Write synthetic bronze data")
    parser.add_argument("--ingest-date", type=date.fromisoformat, default=None)
    parser.add_argument("--output-root", default="data/bronze")
    args = parser.parse_args(argv)
    write_samples(build_session("tidemark-samples"), args.output_root, args.ingest_date)
    print(f"Wrote sample bronze data to {args.output_root}")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
