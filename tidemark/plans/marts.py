"""Stored marts: full rebuild, or the rows that depend on what changed since they were built.

Each mart notes the versions of the tables it was built from. A refresh compares those with the newest
versions, folder by folder and then row by row, so it does not matter how many refreshes or which
interrupted ones lie between; where a version is no longer kept, or rows have gone, the mart is built
anew. Changes go down the layers: price rows to the 30-row frames that hold them, these rows' days to
the two daily marts, which macro observations and company versions change on days of their own.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.aggregates import pivot_series
from tidemark.operators.frames import row_frames, without_keys
from tidemark.operators.temporal import asof_join
from tidemark.plans import gold
from tidemark.plans.refresh import MACRO, PRICES, read_silver
from tidemark.quality.checks import check_table
from tidemark.schemas import PRICE_BAR_FIELDS
from tidemark.session import held, materialized
from tidemark.sources.snapshots import SnapshotTable, time_of
from tidemark.sources.tables import MONTHLY, PERIOD, YEARLY, Warehouse, with_period

SUMMARY, SECTORS, MARKET = "daily_price_summary", "sector_performance", "macro_market_correlation"
COMPANY = "dim_company_snapshot"
SORTED_BY = {SUMMARY: ["ticker", "trade_date"], SECTORS: ["trade_date"], MARKET: ["trade_date"]}
# The daily marts hold few rows a day, whatever the size of the summary.
PERIOD_OF = {SUMMARY: MONTHLY, SECTORS: YEARLY, MARKET: YEARLY}
FRAME = 29  # rows before a row that its metrics look at
# What the daily marts take from the summary.
FACTS = ["close_price", "daily_return_pct", "volume"]


def _stored(spark: SparkSession, warehouse: Warehouse, name: str, periods=None) -> DataFrame:
    return warehouse.read(spark, name, periods).drop(PERIOD)


def _facts(spark: SparkSession, warehouse: Warehouse, periods=None) -> DataFrame:
    return _stored(spark, warehouse, SUMMARY, periods)


def _periods(dates: DataFrame, name: str) -> set[str]:
    """The periods of some dates in a mart; at most twelve a year."""
    return {row[0] for row in with_period(dates, "trade_date", PERIOD_OF[name]).select(PERIOD).distinct().collect()}


def _rebuild(warehouse: Warehouse, name: str, rows: DataFrame, sources: dict[str, str]) -> None:
    placed = with_period(rows, "trade_date", PERIOD_OF[name])
    # the summary is written as the windows leave it, partitioned by ticker; the daily marts are small
    warehouse.replace(placed, name, [PERIOD], SORTED_BY[name], sources, partial(check_table, table=name), in_place=name == SUMMARY)


def _put(spark: SparkSession, warehouse: Warehouse, name: str, rows: DataFrame, replaced: DataFrame, keys: list[str], sources: dict[str, str]) -> None:
    """``rows`` instead of the stored rows whose ``keys`` are in ``replaced``; periods without any stay."""
    placed = with_period(rows, "trade_date", PERIOD_OF[name])
    periods = _periods(replaced.select("trade_date"), name)
    others = without_keys(warehouse.read(spark, name, periods), replaced, keys)
    warehouse.replace_periods(
        others.unionByName(placed), name, periods, SORTED_BY[name], sources, partial(check_table, table=name)
    )


def _summary(spark: SparkSession, warehouse: Warehouse, built: dict[str, str], sources: dict[str, str]) -> bool:
    """Refresh the summary; False if it has to be built anew.

    Keys alone tell the periods that hold a dependent row. Their rows are computed again for every ticker
    with a change, dependent or not, and copied for the others: telling them apart row by row would
    shuffle the stored summary by key, and most rows of such a ticker may depend on a change.
    """
    changed = warehouse.changed(spark, PRICES.name, built.get(PRICES.name), PRICES.keys, list(PRICE_BAR_FIELDS))
    if changed is None:
        return False
    with held(changed) as changed:
        if not changed.filter("gone OR ticker IS NULL OR trade_date IS NULL").isEmpty():
            return False
        with held(changed.select("ticker").distinct()) as tickers:
            prices = read_silver(spark, PRICES, warehouse)
            frames = row_frames(prices.select(*PRICES.keys), changed, *PRICES.keys, FRAME, tickers)
            periods = _periods(frames.filter("dependent"), SUMMARY)
            computed = gold.daily_price_summary(prices.join(tickers, "ticker", "left_semi"))
            rows = with_period(computed, "trade_date", PERIOD_OF[SUMMARY]).filter(F.col(PERIOD).isin(periods))
            others = warehouse.read(spark, SUMMARY, periods).join(tickers, "ticker", "left_anti")
            both = rows.unionByName(others.hint("rebalance", F.col(PERIOD)))
            warehouse.replace_periods(
                both, SUMMARY, periods, SORTED_BY[SUMMARY], sources, partial(check_table, table=SUMMARY), in_place=True
            )
    return True


def _changed_days(spark: SparkSession, warehouse: Warehouse, built: dict[str, str]) -> DataFrame | None:
    """Days of summary rows that are new, differ, or are gone."""
    return warehouse.changed_groups(spark, SUMMARY, built.get(SUMMARY), "trade_date", ["ticker", *FACTS])


def _days_of_companies(spark: SparkSession, warehouse: Warehouse, snapshot: SnapshotTable, built: dict[str, str]) -> DataFrame | None:
    """Days from the earliest snapshot run on that completed after the one the mart was built from."""
    runs, last = snapshot.runs(spark), built.get(COMPANY)
    if last not in runs:
        return None
    first = min((time_of(run)[:10] for run in runs if run > last), default=None)
    days = _facts(spark, warehouse).select("trade_date")
    return days.filter(F.col("trade_date") >= F.lit(first).cast("date") if first else F.lit(False)).distinct()


def _days_of_macro(spark: SparkSession, warehouse: Warehouse, built: dict[str, str]) -> DataFrame | None:
    """Days whose latest macro observation is another one now, or has other values."""
    changed = warehouse.changed(spark, MACRO.name, built.get(MACRO.name), MACRO.keys, ["value"])
    if changed is None:
        return None
    observed = pivot_series(read_silver(spark, MACRO, warehouse)).select(F.col("observation_date").alias("_now"))
    days = _stored(spark, warehouse, MARKET).select("trade_date", F.col("macro_observation_date").alias("_then"))
    restated = changed.select(F.col("observation_date").alias("_now"), F.lit(True).alias("_restated")).distinct()
    placed = asof_join(days, observed, "trade_date", "_now").join(restated, "_now", "left")
    return placed.filter("_restated OR NOT _now <=> _then").select("trade_date").distinct()


def _daily(
    spark: SparkSession, warehouse: Warehouse, name: str, days: list[DataFrame | None], mart: Callable[[DataFrame], DataFrame], sources: dict[str, str]
) -> None:
    """Refresh a mart on the given days, or rebuild it if some are unknown."""
    if any(d is None for d in days):
        _rebuild(warehouse, name, mart(_facts(spark, warehouse)), sources)
        return
    touched = materialized(reduce(DataFrame.union, days).distinct())
    facts = _facts(spark, warehouse, _periods(touched, SUMMARY)).join(touched, "trade_date", "left_semi")
    _put(spark, warehouse, name, mart(facts), touched, ["trade_date"], sources)


def build_marts(
    spark: SparkSession, warehouse: Warehouse, snapshot: SnapshotTable, company: DataFrame, incremental: bool
) -> dict[str, DataFrame]:
    """Bring the three marts up to the stored silver tables and company versions.

    A mart's rows are tested after they are written and before they are published; one that fails
    leaves the version before in place. The tests of silver, which is tested before, let the daily
    marts count tickers plainly: the summary has one row per price, whose key is unique.
    """

    def now(*names: str) -> dict[str, str]:
        found = {n: warehouse.versions(spark, n)[-1] for n in names if n != COMPANY}
        return found | ({COMPANY: (snapshot.runs(spark) or [""])[-1]} if COMPANY in names else {})

    def built(name: str) -> dict[str, str]:
        version = warehouse.version(spark, name) if incremental else None
        return version.sources if version else {}

    sources = now(PRICES.name)
    if built(SUMMARY) != sources and not _summary(spark, warehouse, built(SUMMARY), sources):
        _rebuild(warehouse, SUMMARY, gold.daily_price_summary(read_silver(spark, PRICES, warehouse)), sources)

    sources = now(SUMMARY, COMPANY)
    if (old := built(SECTORS)) != sources:
        days = [_changed_days(spark, warehouse, old), _days_of_companies(spark, warehouse, snapshot, old)]
        mart = partial(gold.sector_performance, company=company, unique=True, by_ticker=False)
        _daily(spark, warehouse, SECTORS, days, mart, sources)

    sources = now(SUMMARY, MACRO.name)
    if (old := built(MARKET)) != sources:
        days = [_changed_days(spark, warehouse, old), _days_of_macro(spark, warehouse, old) if old else None]
        mart = partial(gold.macro_market_correlation, indicators=read_silver(spark, MACRO, warehouse), unique=True)
        _daily(spark, warehouse, MARKET, days, mart, sources)

    return {name: _stored(spark, warehouse, name) for name in (SUMMARY, SECTORS, MARKET)}
