"""Rolling price metrics per ticker."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rolling_metrics(prices: DataFrame) -> DataFrame:
    """Add ma_7d, ma_30d, volatility_30d and prev_close.

    Frames count trading rows, not calendar days, and a short history yields partial averages.

    A moving average is the difference of two running sums, which costs the same per row for any
    frame length; a sliding frame would add up all its rows again for every row. The running
    sums are decimal, so the difference is exact.

    All windows share one shuffle and one sort. The input holds one row per (ticker, trade_date),
    so a window partition never exceeds the number of calendar days, however large the table.
    """
    history = Window.partitionBy("ticker").orderBy("trade_date")
    so_far = history.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    month = history.rowsBetween(-29, Window.currentRow)
    close = F.col("close_price")

    def within(running: str, rows: int) -> Column:
        """A running total minus what it was ``rows`` rows ago."""
        return F.col(running) - F.coalesce(F.lag(running, rows).over(history), F.lit(0))

    def moving_average(rows: int) -> Column:
        # NULL, not a division by zero, where a frame holds no close at all.
        return F.try_divide(within("_sum", rows).cast("double"), within("_count", rows))

    running = prices.withColumns(
        {"_sum": F.sum(close).over(so_far), "_count": F.count(close).over(so_far)}
    )
    return running.withColumns(
        {
            "ma_7d": moving_average(7),
            "ma_30d": moving_average(30),
            "volatility_30d": F.stddev_samp(close).over(month),
            "prev_close": F.lag(close).over(history),
        }
    ).drop("_sum", "_count")
