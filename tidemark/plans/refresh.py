"""Stored silver tables: full rebuild, or merge of newly ingested days."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.dedup import latest_by
from tidemark.operators.upsert import upsert_latest
from tidemark.plans import silver
from tidemark.quality.checks import check_table
from tidemark.schemas import MACRO_FEED, PRICES_FEED, Feed
from tidemark.sources.bronze import read_any_bronze
from tidemark.sources.tables import MONTHLY, PERIOD, YEARLY, Warehouse, with_period


@dataclass(frozen=True)
class SilverTable:
    """How one silver table is derived from its feed."""

    name: str
    feed: Feed
    parse: Callable[[DataFrame], DataFrame]
    keys: list[str]
    date: str
    period: str
    tie_break: list[str]


PRICES = SilverTable(
    "stg_stock_prices",
    PRICES_FEED,
    silver.parse_prices,
    silver.PRICE_KEYS,
    "trade_date",
    MONTHLY,
    silver.PRICE_TIE_BREAK,
)
MACRO = SilverTable(
    "stg_macro_indicators",
    MACRO_FEED,
    silver.parse_macro,
    silver.MACRO_KEYS,
    "observation_date",
    YEARLY,
    silver.MACRO_TIE_BREAK,
)


def rebuild_silver(
    spark: SparkSession, bronze: str, table: SilverTable, warehouse: Warehouse, tested: bool = False
) -> None:
    """Replace the stored table with one derived from all of bronze; ``tested`` as for a merge."""
    rows = table.parse(read_any_bronze(spark, bronze, table.feed, warehouse.root))
    latest = latest_by(rows, table.keys, silver.RECENCY, table.tie_break)
    placed = with_period(latest, table.date, table.period)
    audit = partial(check_table, table=table.name) if tested else None
    warehouse.replace(placed, table.name, partition_by=[PERIOD], sort_by=table.keys, audit=audit)


def merge_bronze(
    bronze: DataFrame, table: SilverTable, warehouse: Warehouse, tested: bool = False
) -> None:
    """Merge the given bronze rows into the stored silver table.

    ``tested``: the merged periods have to pass the table's tests, or they are not published. Periods
    that are taken over have passed them, and a key never lies in two periods.
    """
    upsert_latest(
        table.parse(bronze),
        warehouse,
        table.name,
        keys=table.keys,
        date=table.date,
        period=table.period,
        recency=silver.RECENCY,
        tie_break=table.tie_break,
        audit=partial(check_table, table=table.name) if tested else None,
    )


def refresh_silver(
    spark: SparkSession,
    bronze: str,
    table: SilverTable,
    warehouse: Warehouse,
    since: date | None = None,
    until: date | None = None,
    tested: bool = False,
) -> None:
    """Merge the days ingested in ``[since, until]``; only their bronze folders are read."""
    rows = read_any_bronze(spark, bronze, table.feed, warehouse.root)
    if since is not None:
        rows = rows.filter(F.col("ingest_date") >= F.lit(since))
    if until is not None:
        rows = rows.filter(F.col("ingest_date") <= F.lit(until))
    merge_bronze(rows, table, warehouse, tested)


def read_silver(spark: SparkSession, table: SilverTable, warehouse: Warehouse) -> DataFrame:
    """The stored table without its folder column."""
    return warehouse.read(spark, table.name).drop(PERIOD)
