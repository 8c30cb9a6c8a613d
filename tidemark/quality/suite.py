"""The whole check suite as a job: exit status 1 at the first check that fails.

``python -m tidemark.quality.suite [--bronze-path PATH] [--warehouse PATH]``
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from tidemark.quality.checks import QualityError, check_bronze_freshness, run_checks
from tidemark.quality.gate import bronze_arguments, exit_status
from tidemark.sources.tables import Warehouse


def main(argv: Sequence[str] | None = None) -> int:
    parser = bronze_arguments("Check bronze and the stored price table")
    parser.add_argument("--warehouse", default="data/warehouse")
    parser.add_argument("--min-tickers", type=int, default=2)
    parser.add_argument("--max-tickers", type=int, default=20)
    args = parser.parse_args(argv)

    def checks(spark: SparkSession) -> Sequence[str]:
        warehouse = Warehouse(args.warehouse)
        if not warehouse.versions(spark, "stg_stock_prices"):
            check_bronze_freshness(spark, args.bronze_path, args.max_days_stale)
            raise QualityError(f"Table not found: {warehouse.path('stg_stock_prices')}")
        prices = warehouse.read(spark, "stg_stock_prices")
        tickers = (args.min_tickers, args.max_tickers)
        return [
            *run_checks(spark, args.bronze_path, prices, args.max_days_stale, tickers),
            "All quality checks passed",
        ]

    return exit_status("suite", checks)


if __name__ == "__main__":
    raise SystemExit(main())
