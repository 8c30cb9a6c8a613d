"""Rows that depend on changed rows through row frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def row_frames(
    rows: DataFrame, changed: DataFrame, key: str, order: str, before: int, touched: DataFrame | None = None
) -> DataFrame:
    """The rows whose frame of ``before`` rows up to themselves holds a changed row, marked by
    ``dependent``, together with all rows of those frames, which are not marked themselves.

    ``changed`` holds (key, order) of rows that are new or differ; (key, order) is unique on both
    sides. The rows of a frame are neighbours in the result too, because all rows between the first
    and the last of them are kept: window functions over the result are right for dependent rows.
    Marks travel beside the rows, so there is one shuffle by key after the semi join, and window
    functions by key and order over the result need none; a window partition holds one key's rows.
    ``touched``: the distinct keys of ``changed`` if they are stored; being few, they may be broadcast.
    """
    touched = changed.select(key).distinct() if touched is None else touched
    own = rows.join(touched, key, "left_semi").withColumn("_changed", F.lit(None).cast("boolean"))
    marks = changed.select(key, order, F.lit(True).alias("_changed"))
    both = own.withColumn("_row", F.lit(True)).unionByName(marks.withColumn("_row", F.lit(False)), allowMissingColumns=True)
    history = Window.partitionBy(key).orderBy(order)
    beside = F.max("_changed").over(history.rangeBetween(Window.currentRow, Window.currentRow))
    near = F.max("_changed").over(history.rowsBetween(-before, Window.currentRow))
    needed = F.max("_near").over(history.rowsBetween(Window.currentRow, before))
    marked = both.withColumn("_changed", beside).filter("_row")
    framed = marked.withColumn("_near", near).withColumn("_needed", needed).filter("_needed")
    return framed.select(*rows.columns, F.col("_near").isNotNull().alias("dependent"))


def without_keys(rows: DataFrame, replaced: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` but for those whose keys are in ``replaced``."""
    return rows.join(replaced.select(*keys).distinct(), list(keys), "left_anti")
