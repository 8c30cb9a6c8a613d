"""Freshness of bronze as a job: exit status 0 if it is recent enough, else 1.

``python -m tidemark.quality.gate [--bronze-path PATH] [--max-days-stale N]``
"""

from __future__ import annotations

import argparse
from collections.abc import Callable, Sequence

from pyspark.sql import SparkSession

from tidemark.quality.checks import QualityError, check_bronze_freshness
from tidemark.session import build_session


def bronze_arguments(purpose: str) -> argparse.ArgumentParser:
    """Options that every check job has; names and defaults are fixed by those who call the jobs."""
    parser = argparse.ArgumentParser(description=purpose)
    parser.add_argument("--bronze-path", default="data/bronze")
    parser.add_argument("--max-days-stale", type=int, default=3)
    return parser


def exit_status(name: str, checks: Callable[[SparkSession], Sequence[str]]) -> int:
    """Print what passed, or the first failure; 0 or 1."""
    try:
        for message in checks(build_session(f"tidemark-{name}")):
            print(message)
    except QualityError as failure:
        print(f"{name}: not passed. {failure}")
        return 1
    return 0


def main(argv: Sequence[str] | None = None) -> int:
    args = bronze_arguments("Stop a run whose newest price data is too old").parse_args(argv)
    return exit_status(
        "freshness",
        lambda spark: [check_bronze_freshness(spark, args.bronze_path, args.max_days_stale)],
    )


if __name__ == "__main__":
    raise SystemExit(main())
