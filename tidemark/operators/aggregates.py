"""Daily aggregates and the macro pivot."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numeric import exact_mean
from tidemark.schemas import MACRO_COLUMNS


def pivot_series(indicators: DataFrame, columns: Mapping[str, str] = MACRO_COLUMNS) -> DataFrame:
    """Long (series_id, observation_date, value) to one row per date, one column per series.

    A date on which any series was observed yields a row; the other series are NULL there.
    """
    series, value = F.col("series_id"), F.col("value")
    return indicators.groupBy("observation_date").agg(
        *[F.max(F.when(series == code, value)).alias(name) for code, name in columns.items()]
    )


def _tickers(unique: bool) -> Column:
    """How many tickers; rows that are known to hold each ticker once a day need no distinct count,
    which would send every row through a shuffle by (date, ticker) before the one by date."""
    return F.count("ticker") if unique else F.count_distinct("ticker")


def market_daily(summary: DataFrame, unique: bool = False) -> DataFrame:
    """One row per trade date over all tickers; NULL returns do not count.

    ``unique``: the caller knows that (ticker, trade_date) is unique, by a test or by how it was made.
    """
    return summary.groupBy("trade_date").agg(
        F.avg("daily_return_pct").alias("market_avg_return"),
        F.sum("volume").alias("market_total_volume"),
        _tickers(unique).alias("num_tickers"),
    )


def sector_daily(classified: DataFrame, unique: bool = False) -> DataFrame:
    """One row per (trade date, sector); ``unique`` as for ``market_daily``."""
    return classified.groupBy("trade_date", "sector").agg(
        _tickers(unique).alias("num_companies"),
        F.avg("daily_return_pct").alias("avg_daily_return_pct"),
        F.sum("volume").alias("total_volume"),
        exact_mean(F.col("close_price")).alias("avg_close_price"),
        F.min("close_price").alias("min_close_price"),
        F.max("close_price").alias("max_close_price"),
    )
