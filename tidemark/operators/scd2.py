"""Slowly changing dimension, type 2, with change detection on a list of columns."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

META_COLUMNS = ["dbt_scd_id", "dbt_updated_at", "dbt_valid_from", "dbt_valid_to"]
ABSENT = "absent_at"  # runs, while a version was valid, that its key was missing from


def _differ(one: Column, other: Column, check_cols: Sequence[str]) -> Column:
    return reduce(Column.__or__, [~one[c].eqNullSafe(other[c]) for c in check_cols])


def _version_id(key: Column, run: Column) -> Column:
    return F.md5(F.concat_ws("|", F.coalesce(key.cast("string"), F.lit("")), run.cast("string")))


def scd2_merge(
    open_rows: DataFrame,
    incoming: DataFrame,
    key: str,
    check_cols: Sequence[str],
    as_of: datetime,
) -> DataFrame:
    """One snapshot run: fold ``incoming`` into the currently open versions.

    Returns the rows this run decides on: open versions (``dbt_valid_to`` NULL) and the versions
    it closes. Versions closed by earlier runs never change, so they are not an input; the cost
    of a run is that of the open rows, not of the whole history. Changed keys yield two rows,
    new keys one, unchanged keys and keys missing from ``incoming`` keep their row untouched.
    NULL-safe comparison makes NULL -> value a change and NULL -> NULL none. If the open rows have
    the column ABSENT, versions note the runs that their key was missing from.

    Both sides hold one row per key, so no group can grow hot.
    """
    run = F.lit(as_of).cast("timestamp")
    noted = [ABSENT] if ABSENT in open_rows.columns else []
    old = open_rows.select(F.struct(*incoming.columns, *META_COLUMNS, *noted).alias("old"))
    new = incoming.select(F.struct("*").alias("new"))
    joined = old.join(new, F.col(f"old.{key}") == F.col(f"new.{key}"), "full_outer")

    before, after = F.col("old"), F.col("new")
    differs = _differ(before, after, check_cols)
    opened = F.struct(
        F.col("new.*"),
        _version_id(after[key], run).alias("dbt_scd_id"),
        run.alias("dbt_updated_at"),
        run.alias("dbt_valid_from"),
        F.lit(None).cast("timestamp").alias("dbt_valid_to"),
        *[F.array().cast("array<timestamp>").alias(name) for name in noted],
    )
    missed = before.withField(ABSENT, F.array_append(before[ABSENT], run)) if noted else before
    outcome = (
        F.when(before.isNull(), F.array(opened))
        .when(after.isNull(), F.array(missed))
        .when(differs, F.array(before.withField("dbt_valid_to", run), opened))
        .otherwise(F.array(before))
    )
    return joined.select(F.inline(outcome))


def scd2_splice(
    versions: DataFrame,
    incoming: DataFrame,
    key: str,
    check_cols: Sequence[str],
    as_of: datetime,
    runs: Sequence[datetime],
) -> DataFrame:
    """All versions as they would be had the run at ``as_of`` come in its turn among ``runs``.

    ``versions`` are all of them, with ABSENT, and ``runs`` the times folded in so far. Of a key only
    two versions can change: the one valid at ``as_of`` and the next. A differing row splits the
    valid one and lasts until the run that saw the key next, where the split one goes on or the next
    version, if it is equal, is taken over. Columns that are not compared are those of the version a
    part was split from, as later runs noted no others.

    The two are found by a partial aggregate per key, so a key with many versions costs one row a task.
    """
    run = F.lit(as_of).cast("timestamp")
    every = F.array(*[F.lit(moment).cast("timestamp") for moment in runs])
    columns = [*incoming.columns, *META_COLUMNS, ABSENT]
    row, begins = F.struct(*columns), F.col("dbt_valid_from")
    spots = versions.groupBy(F.col(key).alias("_key")).agg(
        F.max_by(row, F.when(begins <= run, begins)).alias("valid"),
        F.min_by(row, F.when(begins > run, begins)).alias("next"),
    )
    new = incoming.select(F.struct(*incoming.columns).alias("new"))
    joined = spots.join(new, F.col("_key") == F.col(f"new.{key}"), "full_outer")

    valid, after, late = F.col("valid"), F.col("next"), F.col("new")
    ends, none = valid["dbt_valid_to"], F.array().cast("array<timestamp>")

    def part(source: Column, start: Column, end: Column, absent: Column) -> Column:
        return F.struct(
            *[source[name].alias(name) for name in incoming.columns],
            _version_id(source[key], start).alias("dbt_scd_id"),
            start.alias("dbt_updated_at"),
            start.alias("dbt_valid_from"),
            end.alias("dbt_valid_to"),
            absent.alias(ABSENT),
        )

    def between(end: Column) -> Column:
        return F.filter(every, lambda r: (r > run) & (end.isNull() | (r < end)))

    seen = F.when(valid.isNull(), after["dbt_valid_from"]).otherwise(
        F.coalesce(F.array_min(F.array_except(between(ends), valid[ABSENT])), ends)
    )
    joined = joined.withColumn("seen", seen)
    seen = F.col("seen")
    opens = late.isNotNull() & (valid.isNull() | _differ(valid, late, check_cols))
    meets = F.coalesce(seen == after["dbt_valid_from"], F.lit(False)) & ~_differ(after, late, check_cols)
    goes_on = seen.isNotNull() & (ends.isNull() | (seen < ends))
    cut = valid.withField("dbt_valid_to", run).withField(ABSENT, F.filter(valid[ABSENT], lambda r: r < run))
    missed = valid.withField(ABSENT, F.array_sort(F.array_append(valid[ABSENT], run)))
    outcome = F.array(
        F.when(valid.isNotNull(), F.when(late.isNull(), missed).when(opens, cut).otherwise(valid)),
        F.when(opens & meets, part(late, run, after["dbt_valid_to"], F.concat(between(seen), F.coalesce(after[ABSENT], none))))
        .when(opens, part(late, run, seen, between(seen))),
        F.when(
            opens & valid.isNotNull() & goes_on,
            part(valid, seen, ends, F.filter(valid[ABSENT], lambda r: r > seen)),
        ),
        F.when(after.isNotNull() & ~(opens & meets), after),
    )
    changed = joined.select(F.inline(F.filter(outcome, lambda v: v.isNotNull())))
    places = spots.select(
        "_key", F.col("valid.dbt_valid_from").alias("_valid"), F.col("next.dbt_valid_from").alias("_next")
    )
    others = versions.join(places, F.col(key) == F.col("_key")).filter(
        ~begins.eqNullSafe(F.col("_valid")) & ~begins.eqNullSafe(F.col("_next"))
    )
    return others.select(*columns).unionByName(changed)


def scd2_history(
    snapshots: DataFrame, key: str, check_cols: Sequence[str], run_at: str
) -> DataFrame:
    """All versions that running ``scd2_merge`` once per ``run_at``, in order, would leave.

    For loading many recorded snapshots at once: one shuffle by key and one sort, instead of one
    merge per run. ``snapshots`` holds one row per key and run, so a window partition is bounded
    by the number of runs.
    """
    attributes = [c for c in snapshots.columns if c != run_at]
    runs = Window.partitionBy(key).orderBy(run_at)
    checked = F.struct(*check_cols)
    starts_version = F.row_number().over(runs).eqNullSafe(1) | ~checked.eqNullSafe(
        F.lag(checked).over(runs)
    )
    starts = snapshots.withColumn("_starts", starts_version).filter("_starts")
    began = F.col(run_at).cast("timestamp")
    ended = F.lead(began).over(runs)
    return starts.select(
        *attributes,
        _version_id(F.col(key), began).alias("dbt_scd_id"),
        began.alias("dbt_updated_at"),
        began.alias("dbt_valid_from"),
        ended.alias("dbt_valid_to"),
    )
