"""Landing of both feeds from staged responses, followed by the freshness gate.

Run as a job::

    python -m tidemark.plans.ingest --prices DIR --macro DIR --bronze DIR
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import SparkSession

from tidemark.quality.checks import QualityError, check_bronze_freshness
from tidemark.schemas import MACRO_FEED, PRICES_FEED
from tidemark.session import build_session, configure
from tidemark.sources.bronze import IngestionError, LandingReport, land, read_staged


def ingest(
    spark: SparkSession,
    staged_prices: str,
    staged_macro: str,
    bronze: str,
    ingested_at: datetime | None = None,
    max_days_stale: int = 3,
    as_of: date | None = None,
) -> tuple[LandingReport, LandingReport]:
    """Land prices, then macro series, then check freshness; any of them may stop the run.

    A run that is tried again on the same day lands what it has not landed yet.
    """
    configure(spark)
    prices = land(read_staged(spark, staged_prices, PRICES_FEED), bronze, PRICES_FEED, ingested_at, once=True)
    macro = land(read_staged(spark, staged_macro, MACRO_FEED), bronze, MACRO_FEED, ingested_at, once=True)
    check_bronze_freshness(spark, bronze, max_days_stale, as_of)
    return prices, macro


def main(argv: Sequence[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description="Land staged responses in bronze")
    parser.add_argument("--prices", required=True, help="folder of staged price responses")
    parser.add_argument("--macro", required=True, help="folder of staged macro responses")
    parser.add_argument("--bronze", default="data/bronze")
    parser.add_argument("--max-days-stale", type=int, default=3)
    args = parser.parse_args(argv)
    spark = build_session("tidemark-ingest")
    try:
        prices, macro = ingest(
            spark, args.prices, args.macro, args.bronze, max_days_stale=args.max_days_stale
        )
    except (IngestionError, QualityError) as failure:
        print(f"Ingestion failed: {failure}")
        return 1
    print(f"Landed {prices.landed} price and {macro.landed} macro responses")
    print(f"Set aside {prices.rejected} price responses")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
