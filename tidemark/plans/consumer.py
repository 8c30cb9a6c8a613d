"""Queries that consumers run over the finished tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_recent_prices(summary: DataFrame, limit: int = 10) -> DataFrame:
    """The newest rows over all tickers."""
    return (
        summary.select("ticker", "trade_date", "close_price", "ma_7d", "daily_return_pct")
        .orderBy(F.desc_nulls_last("trade_date"), F.asc_nulls_last("ticker"))
        .limit(limit)
    )


def ticker_history(summary: DataFrame, ticker: str, limit: int = 10) -> DataFrame:
    """The newest rows of one ticker."""
    return (
        summary.filter(F.col("ticker") == ticker)
        .select(
            "ticker",
            "trade_date",
            "close_price",
            "ma_7d",
            "ma_30d",
            "volatility_30d",
            "daily_return_pct",
        )
        .orderBy(F.desc_nulls_last("trade_date"))
        .limit(limit)
    )


def sector_ranking(sectors: DataFrame) -> DataFrame:
    """All sector days, newest first, best return first within a day."""
    return sectors.select(
        "trade_date", "sector", "num_companies", "avg_daily_return_pct", "total_volume"
    ).orderBy(F.desc_nulls_last("trade_date"), F.desc_nulls_last("avg_daily_return_pct"))


def sector_by_day(sectors: DataFrame) -> DataFrame:
    """All sector days, newest first, sectors in name order."""
    return sectors.orderBy(F.desc_nulls_last("trade_date"), F.asc_nulls_last("sector"))


def macro_context(market: DataFrame, limit: int = 10) -> DataFrame:
    """The newest market days beside their macro context."""
    return (
        market.select(
            "trade_date", "market_avg_return", "fed_funds_rate", "unemployment_rate", "cpi"
        )
        .orderBy(F.desc_nulls_last("trade_date"))
        .limit(limit)
    )


def market_by_day(market: DataFrame) -> DataFrame:
    """All market days, newest first."""
    return market.orderBy(F.desc_nulls_last("trade_date"))


def company_history(company: DataFrame, ticker: str) -> DataFrame:
    """All versions of one company, oldest first."""
    return (
        company.filter(F.col("ticker") == ticker)
        .select("ticker", "company_name", "sector", "valid_from", "valid_to", "is_current")
        .orderBy(F.asc_nulls_last("valid_from"))
    )
