"""Numeric expressions whose result must not depend on row order or on decimal scale rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def exact_mean(value: Column) -> Column:
    """Mean of a decimal column as double.

    The sum stays decimal, so it is exact and the same for every row order; only the final
    division is floating point. (``avg`` on decimal would return a decimal rounded to 8 digits.)
    """
    return F.try_divide(F.sum(value).cast("double"), F.count(value))


def change_pct(current: Column, previous: Column) -> Column:
    """Percentage change, NULL where there is no positive previous value."""
    change = (current - previous).cast("double")  # exact before it becomes floating point
    return F.when(previous > 0, change / previous.cast("double") * 100)
