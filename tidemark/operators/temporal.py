"""Joins on time: point-in-time validity and as-of."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import materialized


def pit_join(
    facts: DataFrame,
    dimension: DataFrame,
    key: str,
    date: str,
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
) -> DataFrame:
    """Inner join of each fact with the dimension version valid on its date.

    Validity is half open and compared by day: on the day of a change the new version applies,
    and a version opened and closed on one day matches nothing. The key equality makes this an
    equi-join with a residual range predicate, so Spark broadcasts the dimension only if it is
    under the broadcast threshold and otherwise shuffles by key, where AQE can split hot keys.
    """
    versions = dimension.withColumnsRenamed({key: "_key"})
    on = (
        (F.col(key) == F.col("_key"))
        & (F.col(date) >= F.col(valid_from).cast("date"))
        & (F.col(date) < F.col(valid_to).cast("date"))
    )
    return facts.join(versions, on, "inner").drop("_key")


def pit_join_bucketed(
    facts: DataFrame,
    dimension: DataFrame,
    key: str,
    date: str,
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    days: int = 32,
) -> DataFrame:
    """``pit_join`` for keys with many versions.

    A version is listed in every span of ``days`` days that its validity touches, within the days
    that occur in ``facts``; a fact looks into the one span of its date. So a fact meets the versions
    valid in its span, some ``days`` at most where versions do not overlap, instead of all versions
    of its key, and a hot key is spread over its spans. Two values are collected: the first and the
    last day of ``facts``. Listing costs a row per version and touched span; versions that last for
    years among spans of a month make the dimension longer, so plain ``pit_join`` suits few versions.
    """

    def span(day: Column) -> Column:
        return F.floor(F.unix_date(day) / days)

    first, last = facts.agg(F.min(date), F.max(date)).first()
    opened = F.greatest(F.col(valid_from).cast("date"), F.lit(first).cast("date"))
    closes = F.least(F.date_sub(F.col(valid_to).cast("date"), 1), F.lit(last).cast("date"))
    versions = dimension.withColumnsRenamed({key: "_key"}).filter(opened <= closes)
    listed = versions.withColumn("_span", F.explode(F.sequence(span(opened), span(closes))))
    on = (
        (F.col(key) == F.col("_key"))
        & (F.col("_at") == F.col("_span"))
        & (F.col(date) >= F.col(valid_from).cast("date"))
        & (F.col(date) < F.col(valid_to).cast("date"))
    )
    return facts.withColumn("_at", span(F.col(date))).join(listed, on, "inner").drop("_key", "_span", "_at")


def asof_join(left: DataFrame, right: DataFrame, left_on: str, right_on: str) -> DataFrame:
    """Left join of each row with the latest right row dated on or before it.

    ``right`` must have one row per date; ValueError if it has not. It is evaluated once, into the
    shared folder. Each right row is spread over the days until the next one, which turns the as-of
    condition into an equality on the day; days after the last right row are clamped to it. The day
    table holds one row per calendar day between the first and the last right date, whatever the
    size of ``left``. No side is forced: Spark broadcasts the day table if it is under its threshold
    and else shuffles both by day, where AQE can split hot days. The window that finds the next date
    runs over the right dates only.
    """
    right = materialized(right.filter(F.col(right_on).isNotNull()))
    rows, dates, latest = right.agg(
        F.count(F.lit(1)), F.count_distinct(right_on), F.max(right_on)
    ).first()
    if rows != dates:
        raise ValueError(f"{rows} rows for {dates} values of {right_on}: one row per date is needed")
    following = F.lead(right_on).over(Window.orderBy(right_on))
    last_day = F.greatest(F.date_sub(F.col("_next"), 1), F.col(right_on))
    by_day = right.withColumn("_next", following).withColumn(
        "_day", F.explode(F.sequence(F.col(right_on), last_day))
    )
    # ``least`` ignores NULLs, but a row without a date has no right row.
    lookup_day = F.when(F.col(left_on).isNotNull(), F.least(F.col(left_on), F.lit(latest).cast("date")))
    keyed = left.withColumn("_lookup_day", lookup_day)
    joined = keyed.join(by_day, F.col("_lookup_day") == F.col("_day"), "left")
    return joined.drop("_lookup_day", "_day", "_next")


def asof_join_ranged(
    left: DataFrame, right: DataFrame, left_on: str, right_on: str, tie_break: Sequence[str] = ()
) -> DataFrame:
    """Left join of each row with the latest right row at or before its time; both sides of any size.

    Times may be dates, timestamps or numbers. Of right rows at one time the one with the greatest
    ``tie_break`` columns is taken (all columns, in their order, if there are none). A left row without
    a time, or before all right rows, gets NULLs; right rows without a time are ignored.

    The distinct times of both sides are partitioned by ranges, so a time that many rows share is one
    row. Inside a range the last right row is carried forward; what a range begins with is the last
    right row of the ranges before it, a prefix scan over one time per range. Left rows then meet
    their right row by equality of the time, where AQE splits a hot one.
    """
    names = right.columns
    order = [*(tie_break or [n for n in names if n != right_on])]
    dated = right.filter(F.col(right_on).isNotNull())
    newest = F.max_by(F.struct(*names), F.struct(*order)) if order else F.first(F.struct(*names))
    rows = dated.groupBy(F.col(right_on).alias("_time")).agg(newest.alias("_row"))
    times = left.select(F.col(left_on).alias("_time")).filter(F.col("_time").isNotNull()).distinct()
    no_row = F.lit(None).cast(rows.schema["_row"].dataType)
    both = rows.unionByName(times.select("_time", no_row.alias("_row"))).groupBy("_time").agg(F.first("_row", ignorenulls=True).alias("_row"))
    ranged = materialized(both.repartitionByRange("_time").withColumn("_range", F.spark_partition_id()))

    # one value per range is collected: the time of its last right row
    last = F.max(F.when(F.col("_row").isNotNull(), F.col("_time")))
    begins, carried = [], None
    for number, time in sorted(ranged.groupBy("_range").agg(last).collect()):
        begins.append((number, carried))
        carried = time if time is not None else carried
    schema = T.StructType([T.StructField("_range", T.IntegerType()), T.StructField("_from", ranged.schema["_time"].dataType)])
    first = left.sparkSession.createDataFrame(begins, schema).join(
        ranged.select(F.col("_time").alias("_from"), F.col("_row").alias("_first")), "_from"
    )
    within = Window.partitionBy("_range").orderBy("_time")
    found = (
        ranged.withColumn("_carried", F.last("_row", ignorenulls=True).over(within))
        .join(first.select("_range", "_first"), "_range", "left")
        .select("_time", F.coalesce("_carried", "_first").alias("_row"))
    )
    joined = left.join(found, F.col(left_on) == F.col("_time"), "left")
    return joined.select(*[left[n] for n in left.columns], *[F.col("_row")[n].alias(n) for n in names])
