"""Latest-wins deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def newest_first(keys: Sequence[str], recency: str, tie_break: Sequence[str] = ()) -> WindowSpec:
    """The rows of a key from the most recent one on, as ``latest_by`` ranks them."""
    return Window.partitionBy(*keys).orderBy(*[F.col(name).desc_nulls_last() for name in (recency, *tie_break)])


def latest_by(
    df: DataFrame, keys: Sequence[str], recency: str, tie_break: Sequence[str] = ()
) -> DataFrame:
    """Keep, per key, the row with the greatest ``recency``; NULL recency loses to any value.

    Rows that tie are ordered by the ``tie_break`` columns, so the winner does not depend on how
    the input was partitioned. Filtering the rank to 1 lets Spark place a WindowGroupLimit below
    the shuffle: every map task sends on at most one row per key, so a key that holds a large
    share of all rows costs one row per map task, not a partition.
    """
    ranked = newest_first(keys, recency, tie_break)
    return df.withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1").drop("_rank")
