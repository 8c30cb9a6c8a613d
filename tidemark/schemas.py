"""Table contracts of every layer, and the fixed names and texts of the two raw feeds."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

PRICE = T.DecimalType(18, 4)

# --- Fixed values: names and texts that the raw feeds and their consumers use -----------------
PRICE_SERIES_KEY = "Time Series (Daily)"
PRICE_BAR_FIELDS = {
    "open_price": "1. open",
    "high_price": "2. high",
    "low_price": "3. low",
    "close_price": "4. close",
    "volume": "5. volume",
}
OBSERVATIONS_KEY = "observations"
MISSING_VALUE = "."
UNKNOWN_ERROR = "Unknown error"
MACRO_COLUMNS = {
    "FEDFUNDS": "fed_funds_rate",
    "CPIAUCSL": "cpi",
    "UNRATE": "unemployment_rate",
    "GDP": "gdp",
}
OPEN_END = "9999-12-31 23:59:59"
# ----------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Feed:
    """What distinguishes one raw feed from another when it is validated and landed."""

    table: str
    key: str
    source: str
    required: str
    error_fields: tuple[str, ...]
    failure_policy: str  # "all": raise only if every response failed; "any": raise on the first
    api_function: str | None = None

    @property
    def columns(self) -> list[str]:
        extra = ["api_function"] if self.api_function else []
        return [self.key, "raw_payload", "ingested_at", "source", *extra]

    @property
    def schema(self) -> T.StructType:
        fields = [T.StructField(name, T.StringType()) for name in self.columns]
        return T.StructType([*fields, T.StructField("ingest_date", T.DateType())])


# Names that stored responses carry, and what each feed tolerates.
PRICES_FEED = Feed(
    table="daily_prices_raw",
    key="ticker",
    source="alpha_vantage",
    required=PRICE_SERIES_KEY,
    error_fields=("Note", "Error Message", "Information"),
    failure_policy="all",
    api_function="TIME_SERIES_DAILY",
)
MACRO_FEED = Feed(
    table="fred_series_raw",
    key="series_id",
    source="fred",
    required=OBSERVATIONS_KEY,
    error_fields=("error_message",),
    failure_policy="any",
)

COMPANY_SEED = T.StructType(
    [
        T.StructField("ticker", T.StringType()),
        T.StructField("company_name", T.StringType()),
        T.StructField("sector", T.StringType()),
        T.StructField("exchange", T.StringType()),
        T.StructField("effective_date", T.DateType()),
    ]
)
COMPANY_KEY = "ticker"
COMPANY_CHECK_COLUMNS = ["company_name", "sector", "exchange"]

SNAPSHOT_META = T.StructType(
    [
        T.StructField("dbt_scd_id", T.StringType()),
        T.StructField("dbt_updated_at", T.TimestampType()),
        T.StructField("dbt_valid_from", T.TimestampType()),
        T.StructField("dbt_valid_to", T.TimestampType()),
    ]
)
COMPANY_SNAPSHOT = T.StructType([*COMPANY_SEED.fields, *SNAPSHOT_META.fields])

STOCK_PRICES = T.StructType(
    [
        T.StructField("ticker", T.StringType()),
        T.StructField("trade_date", T.DateType()),
        T.StructField("open_price", PRICE),
        T.StructField("high_price", PRICE),
        T.StructField("low_price", PRICE),
        T.StructField("close_price", PRICE),
        T.StructField("volume", T.LongType()),
        T.StructField("last_updated_at", T.TimestampType()),
    ]
)
MACRO_INDICATORS = T.StructType(
    [
        T.StructField("series_id", T.StringType()),
        T.StructField("observation_date", T.DateType()),
        T.StructField("value", PRICE),
        T.StructField("last_updated_at", T.TimestampType()),
    ]
)

# Columns that must never be NULL, and keys that must never repeat, per table.
NOT_NULL = {
    "stg_stock_prices": [
        "ticker", "trade_date", "open_price", "high_price", "low_price", "close_price", "volume",
    ],
    "stg_macro_indicators": ["series_id", "observation_date", "value"],
    "daily_price_summary": ["ticker", "trade_date", "close_price"],
    "sector_performance": ["trade_date", "sector"],
    "macro_market_correlation": ["trade_date"],
}
UNIQUE_KEYS = {
    "stg_stock_prices": ["ticker", "trade_date"],
    "stg_macro_indicators": ["series_id", "observation_date"],
}
