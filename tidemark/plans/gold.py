"""Gold marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numeric import change_pct
from tidemark.operators.aggregates import market_daily, pivot_series, sector_daily
from tidemark.operators.rolling import rolling_metrics
from tidemark.operators.temporal import asof_join, pit_join


def daily_price_summary(prices: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """Prices with moving averages, volatility, change and return; one row per input row, which keeps ``carried``."""
    close, previous = F.col("close_price"), F.col("prev_close")
    return rolling_metrics(prices).select(
        "ticker",
        "trade_date",
        "open_price",
        "high_price",
        "low_price",
        "close_price",
        "volume",
        "ma_7d",
        "ma_30d",
        "volatility_30d",
        (close - previous).alias("daily_change"),
        change_pct(close, previous).alias("daily_return_pct"),
        *carried,
    )


def sector_performance(
    summary: DataFrame, company: DataFrame, unique: bool = False, by_ticker: bool = True
) -> DataFrame:
    """Daily aggregates per sector, by the sector each company had on that day.

    ``unique``: (ticker, trade_date) is unique in ``summary``, by a test or by how it was made. ``by_ticker``:
    its rows are still partitioned and sorted by ticker, as the rolling window leaves them; a merge
    join then shuffles the dimension only. Rows read back from storage are not.
    """
    facts = summary.select("ticker", "trade_date", "close_price", "daily_return_pct", "volume")
    versions = company.select("ticker", "sector", "valid_from", "valid_to")
    facts = facts.hint("merge") if by_ticker else facts
    return sector_daily(pit_join(facts, versions, key="ticker", date="trade_date"), unique)


def macro_market_correlation(
    summary: DataFrame, indicators: DataFrame, unique: bool = False
) -> DataFrame:
    """Market aggregates per day beside the latest macro observation up to that day.

    ``unique`` as for ``sector_performance``.
    """
    macro = pivot_series(indicators).withColumnRenamed("observation_date", "macro_observation_date")
    return asof_join(
        market_daily(summary, unique), macro, left_on="trade_date", right_on="macro_observation_date"
    ).select(
        "trade_date",
        "market_avg_return",
        "market_total_volume",
        "num_tickers",
        "fed_funds_rate",
        "cpi",
        "unemployment_rate",
        "gdp",
        "macro_observation_date",
    )
