"""Incremental upsert into a table stored by period."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.dedup import latest_by, newest_first
from tidemark.session import held
from tidemark.sources.tables import CHANGED, PERIOD, Warehouse, number_of, with_period


def upsert_latest(
    updates: DataFrame,
    warehouse: Warehouse,
    table: str,
    keys: Sequence[str],
    date: str,
    period: str,
    recency: str,
    tie_break: Sequence[str],
    audit: Callable[[DataFrame], None] | None = None,
) -> None:
    """Merge ``updates`` into a stored table; per key the most recent row wins.

    The date is part of the key, so a key never leaves its period: only periods with updates are
    read, merged and written, to a new version that takes over all others. The choice between stored
    and new row uses the same ordering as a full rebuild, so both end with the same rows, and merging
    the same updates twice changes nothing. Nothing that is published is ever written to, so a merge
    that dies leaves no trace that a later merge or rebuild could meet.

    A key whose values (all but ``recency``) are new notes the version that brought them, so what a
    merge changed can be read from the stored rows; comparing two versions would shuffle both of them.
    The rows are written by the tasks that merged them: they pass one shuffle.
    """
    spark = updates.sparkSession
    fresh = with_period(latest_by(updates, keys, recency, tie_break), date, period)
    if warehouse.version(spark, table) is None:
        warehouse.replace_periods(fresh, table, [], sort_by=keys, audit=audit, in_place=True)
        return
    with held(fresh) as fresh:
        # At most twelve values per calendar year.
        touched = {row[0] for row in fresh.select(PERIOD).distinct().collect()}
        if touched:
            stored, number = warehouse.read_marked(spark, table, touched), number_of(warehouse.next_name(spark, table))
            merged = _merged(stored.drop(PERIOD), fresh.drop(PERIOD), number, keys, recency, tie_break)
            placed = with_period(merged, date, period)
            warehouse.replace_periods(placed, table, touched, sort_by=keys, audit=audit, in_place=True)


def _merged(
    stored: DataFrame, fresh: DataFrame, number: int, keys: Sequence[str], recency: str, tie_break: Sequence[str]
) -> DataFrame:
    """The latest of at most one stored and one fresh row per key; stored rows are those with a mark.

    A fresh row that wins over a stored one with the same values keeps its mark, else it gets ``number``.
    Rows are partitioned by the first key (a ticker, a series), which has at most two rows per date:
    they lie together in what is shuffled and in the files, which compresses both.
    """
    values = F.struct(*[name for name in fresh.columns if name not in (*keys, recency)])
    ties = [*tie_break, CHANGED]
    beaten = F.lead(F.struct(F.col(CHANGED).alias("mark"), values.alias("values"))).over(newest_first(keys, recency, ties))
    both = stored.unionByName(fresh.withColumn(CHANGED, F.lit(None).cast("int"))).repartition(keys[0])
    same = F.col("_beaten")["values"].eqNullSafe(values)
    mark = F.coalesce(CHANGED, F.when(same, F.col("_beaten")["mark"]), F.lit(number))
    return latest_by(both.withColumn("_beaten", beaten), keys, recency, ties).withColumn(CHANGED, mark).drop("_beaten")
