"""Run registered queries beside their SQL twins and report differences.

``python tests/oracle_check.py SF_DIR [query ...]``
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from tidemark.session import build_session  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def as_multiset(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def compare(spark, connection, name: str, sf_dir: str) -> str:
    """Empty if both sides agree, else a description of how they differ."""
    result = entry.queries()[name](spark, sf_dir)
    ours = as_multiset(result.columns, result.collect())
    answer = connection.execute(entry.oracle_sql()[name])
    columns = [column[0] for column in answer.description]
    theirs = as_multiset(columns, answer.fetchall())
    if sorted(columns) != sorted(result.columns):
        return f"columns {sorted(result.columns)} != {sorted(columns)}"
    if ours != theirs:
        return (
            f"{sum(ours.values())} vs {sum(theirs.values())} rows; "
            f"only ours {list((ours - theirs).items())[:3]}; "
            f"only theirs {list((theirs - ours).items())[:3]}"
        )
    return "" if ours else "both empty"


def main() -> int:
    sf_dir, names = sys.argv[1], sys.argv[2:] or list(entry.oracle_sql())
    spark = build_session(
        master="local[8]",
        extra={
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "12g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, failed = duck(sf_dir), 0
    for name in names:
        start = time.time()
        try:
            difference = compare(spark, connection, name, sf_dir)
        except Exception as error:  # a report tool: show the error and go on
            difference = f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(difference)
        print(f"{'FAIL' if difference else 'ok  '} {name} {time.time() - start:.2f}s {difference}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return failed


if __name__ == "__main__":
    raise SystemExit(main())
