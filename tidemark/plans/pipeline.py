"""The whole build, in blocking order: a step that fails stops everything after it.

Run as a job::

    python -m tidemark.plans.pipeline --bronze DIR --seed FILE --warehouse DIR [--since DAY]
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans import silver
from tidemark.plans.marts import build_marts
from tidemark.plans.refresh import MACRO, PRICES, read_silver, rebuild_silver, refresh_silver
from tidemark.quality.checks import QualityError, not_null, unique_combination
from tidemark.schemas import (
    COMPANY_CHECK_COLUMNS,
    COMPANY_KEY,
    COMPANY_SNAPSHOT,
)
from tidemark.session import build_session, configure
from tidemark.sources.seeds import read_seed
from tidemark.sources.snapshots import SnapshotTable
from tidemark.sources.tables import Warehouse, register_databases, register_view, register_views

# Tables that are stored by version; the snapshot has run folders of its own.
STORED = [
    "company_metadata",
    "stg_stock_prices",
    "stg_macro_indicators",
    "daily_price_summary",
    "sector_performance",
    "macro_market_correlation",
]


@dataclass(frozen=True)
class Config:
    bronze: str
    warehouse: str
    seed: str | None = None
    incremental_since: date | None = None


def company_snapshot(warehouse: Warehouse) -> SnapshotTable:
    return SnapshotTable(
        warehouse.path("dim_company_snapshot"), COMPANY_SNAPSHOT, COMPANY_KEY, COMPANY_CHECK_COLUMNS,
        warehouse.published("dim_company_snapshot"),
    )


def register_tables(spark: SparkSession, warehouse: Warehouse) -> None:
    """Make every table queryable under its full name, for good: the names are views that find the
    newest published state whenever they are queried."""
    register_databases(spark, warehouse, STORED)
    register_view(spark, "dim_company_snapshot", company_snapshot(warehouse).query())
    register_view(spark, "dim_company", silver.DIM_COMPANY_SQL)


def check_seed(metadata: DataFrame) -> None:
    """A company without a ticker, or with two rows, would multiply versions and then facts."""
    for test in (
        not_null(metadata, "company_metadata", [COMPANY_KEY]),
        unique_combination(metadata, "company_metadata", [COMPANY_KEY]),
    ):
        failed = test.filter(~F.col("passed")).first()
        if failed is not None:
            raise QualityError(
                f"{failed['check']} failed on company_metadata({failed['column']}): "
                f"{failed['failures']} failures"
            )


def build(
    spark: SparkSession,
    config: Config,
    run_at: datetime | None = None,
    seed: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Seed, snapshot, silver, gold; returns the tables by name.

    A table is written, tested, and published if it passes; one that fails stops the build and leaves
    its last version in place. With ``incremental_since`` silver merges the days ingested from then
    on, and the marts change where rows they depend on have changed. Every table is written before the next step reads it, so its lineage ends in files and the
    loss of an executor never reaches back beyond the current step.
    """
    configure(spark)
    warehouse = Warehouse(config.warehouse)
    tables: dict[str, DataFrame] = {}

    metadata = seed if seed is not None else read_seed(spark, config.seed)
    tables["company_metadata"] = warehouse.replace(metadata, "company_metadata")

    check_seed(tables["company_metadata"])
    snapshot = company_snapshot(warehouse)
    snapshot.run(
        tables["company_metadata"], run_at or datetime.now(timezone.utc).replace(tzinfo=None)
    )
    tables["dim_company_snapshot"] = snapshot.history(spark)
    if tables["dim_company_snapshot"].isEmpty() and not tables["company_metadata"].isEmpty():
        raise QualityError("the company snapshot is empty after a run over a seed that is not")
    tables["dim_company"] = silver.dim_company(tables["dim_company_snapshot"])

    for table in (PRICES, MACRO):
        if config.incremental_since is None:
            rebuild_silver(spark, config.bronze, table, warehouse, tested=True)
        else:
            refresh_silver(spark, config.bronze, table, warehouse, since=config.incremental_since, tested=True)
        tables[table.name] = read_silver(spark, table, warehouse)

    incremental = config.incremental_since is not None
    tables |= build_marts(spark, warehouse, snapshot, tables["dim_company"], incremental)

    register_views(tables)
    return tables


def main(argv: Sequence[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description="Build silver and gold tables from bronze")
    parser.add_argument("--bronze", default="data/bronze")
    parser.add_argument("--warehouse", default="data/warehouse")
    parser.add_argument("--seed", required=True, help="company metadata CSV")
    parser.add_argument(
        "--since",
        type=date.fromisoformat,
        default=None,
        help="merge only days ingested from here on, instead of rebuilding silver and gold",
    )
    args = parser.parse_args(argv)
    spark = build_session("tidemark-build")
    config = Config(
        bronze=args.bronze,
        warehouse=args.warehouse,
        seed=args.seed,
        incremental_since=args.since,
    )
    try:
        tables = build(spark, config)
    except QualityError as failure:
        print(f"Build stopped: {failure}")
        return 1
    register_tables(spark, Warehouse(config.warehouse))
    print(f"Built {', '.join(sorted(tables))}")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
