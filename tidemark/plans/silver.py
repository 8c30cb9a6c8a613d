"""Silver tables: typed, deduplicated rows out of raw payloads, and the company dimension."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.payload import (
    daily_bars,
    integral,
    observations,
    payload_text,
    variant_bars,
    variant_text,
)
from tidemark.operators.dedup import latest_by
from tidemark.schemas import MISSING_VALUE, OPEN_END, PRICE, PRICE_BAR_FIELDS

PRICE_KEYS = ["ticker", "trade_date"]
PRICE_TIE_BREAK = ["close_price", "open_price", "high_price", "low_price", "volume"]
MACRO_KEYS = ["series_id", "observation_date"]
MACRO_TIE_BREAK = ["value"]
RECENCY = "last_updated_at"


def parse_prices(bronze: DataFrame) -> DataFrame:
    """One typed row per (response, date), not yet deduplicated."""
    bars = bronze.select(
        "ticker",
        F.col("ingested_at").cast("timestamp").alias(RECENCY),
        F.explode(daily_bars(payload_text(bronze))).alias("day", "bar"),
    )
    return _typed_bars(bars, lambda field: F.col("bar")[field])


def parse_variant_prices(bronze: DataFrame) -> DataFrame:
    """``parse_prices`` by way of VARIANT, without a declared payload schema."""
    timed = bronze.withColumn(RECENCY, F.col("ingested_at").cast("timestamp"))
    bars = variant_bars(timed, "ticker", RECENCY)
    return _typed_bars(bars, lambda field: variant_text(F.col("bar"), field))


def _typed_bars(bars: DataFrame, text: Callable[[str], Column]) -> DataFrame:
    """Typed columns of (ticker, day, bar); ``text`` gives a field of the bar as text."""
    prices = [text(field).cast(PRICE).alias(name) for name, field in PRICE_BAR_FIELDS.items() if name != "volume"]
    volume = integral(text(PRICE_BAR_FIELDS["volume"])).alias("volume")
    return bars.select("ticker", F.col("day").cast("date").alias("trade_date"), *prices, volume, RECENCY)


def stg_stock_prices(bronze: DataFrame) -> DataFrame:
    """One row per (ticker, trade_date): the most recently ingested bar."""
    return latest_by(parse_prices(bronze), PRICE_KEYS, RECENCY, PRICE_TIE_BREAK)


def parse_macro(bronze: DataFrame) -> DataFrame:
    """One typed row per (response, observation), without missing or unparseable values."""
    rows = bronze.select(
        "series_id",
        F.col("ingested_at").cast("timestamp").alias(RECENCY),
        F.inline(observations(payload_text(bronze))).alias("date", "text"),
    )
    return (
        rows.filter(F.col("text") != MISSING_VALUE)
        .withColumn("value", F.col("text").try_cast(PRICE))
        .filter(F.col("value").isNotNull())
        .select("series_id", F.col("date").cast("date").alias("observation_date"), "value", RECENCY)
    )


def stg_macro_indicators(bronze: DataFrame) -> DataFrame:
    """One row per (series_id, observation_date): the most recently ingested value."""
    return latest_by(parse_macro(bronze), MACRO_KEYS, RECENCY, MACRO_TIE_BREAK)


def dim_company(snapshot: DataFrame) -> DataFrame:
    """Readable view of the snapshot: open versions end at a far-away sentinel."""
    valid_to = F.col("dbt_valid_to")
    return snapshot.select(
        "ticker",
        "company_name",
        "sector",
        "exchange",
        "effective_date",
        F.col("dbt_valid_from").alias("valid_from"),
        F.coalesce(valid_to, F.lit(OPEN_END).cast("timestamp")).alias("valid_to"),
        valid_to.isNull().alias("is_current"),
    )


# The same view as catalog text, over the snapshot's full name.
DIM_COMPANY_SQL = f"""
SELECT ticker, company_name, sector, exchange, effective_date, dbt_valid_from AS valid_from,
       coalesce(dbt_valid_to, TIMESTAMP '{OPEN_END}') AS valid_to, dbt_valid_to IS NULL AS is_current
FROM main.dim_company_snapshot
"""
