from __future__ import annotations

from datetime import date, timedelta

import pytest
from helpers import plan_of, stocks, tuples
from pyspark.sql import functions as F

from tidemark.quality import gate
from tidemark.quality.checks import (
    QualityError,
    check_bronze_freshness,
    check_no_negative_prices,
    check_report,
    check_table,
    check_ticker_count,
    freshness,
    not_null,
    run_checks,
    unique_combination,
)
from tidemark.schemas import NOT_NULL, PRICES_FEED, UNIQUE_KEYS
from tidemark.sources.bronze import append_bronze
from tidemark.sources.samples import sample_prices

RESULT = ["check", "table", "column", "failures", "passed"]


def tickers(spark, count):
    return stocks(spark, [(f"T{i}", "2026-01-06", 1) for i in range(count)] + [("OLD", "2026-01-05", 1)])


def test_declared_tests():
    assert sum(len(columns) for columns in NOT_NULL.values()) == 16
    assert len(UNIQUE_KEYS) == 2


def test_not_null_counts_every_column_in_one_pass(spark):
    df = stocks(spark, [("A", "2026-01-05", None), (None, "2026-01-05", 1), ("B", "2026-01-05", None)])
    assert tuples(not_null(df, "t", ["ticker", "close_price", "volume"]), *RESULT) == [
        ("not_null", "t", "close_price", 2, False),
        ("not_null", "t", "ticker", 1, False),
        ("not_null", "t", "volume", 0, True),
    ]


def test_unique_combination_counts_repeated_keys(spark):
    df = stocks(spark, [("A", "2026-01-05", 1)] * 3 + [("A", "2026-01-06", 1), ("B", "2026-01-05", 1)])
    keys = ["ticker", "trade_date"]
    assert tuples(unique_combination(df, "t", keys), *RESULT) == [
        ("unique_combination", "t", "ticker,trade_date", 1, False)
    ]
    assert unique_combination(df.dropDuplicates(keys), "t", keys).first()["passed"]


def test_check_table_raises_on_the_first_failure(spark):
    check_table(stocks(spark, [("A", "2026-01-05", 1)]), "stg_stock_prices")
    with pytest.raises(QualityError, match=r"not_null failed on stg_stock_prices\(open_price\)"):
        check_table(stocks(spark, [("A", "2026-01-05", None)]), "stg_stock_prices")
    with pytest.raises(QualityError, match="unique_combination failed"):
        check_table(stocks(spark, [("A", "2026-01-05", 1)] * 2), "stg_stock_prices")
    check_table(stocks(spark, []), "stg_stock_prices")


@pytest.mark.parametrize("age, passes", [(0, True), (3, True), (4, False), (10, False)])
def test_freshness_limit_is_inclusive(spark, tmp_path, age, passes):
    today = date(2026, 2, 1)
    append_bronze(sample_prices(spark, today - timedelta(days=age)), str(tmp_path), PRICES_FEED)
    append_bronze(sample_prices(spark, today - timedelta(days=30)), str(tmp_path), PRICES_FEED)
    if passes:
        assert f"({age} days old)" in check_bronze_freshness(spark, str(tmp_path), 3, today)
    else:
        with pytest.raises(QualityError, match=f"{age} days stale"):
            check_bronze_freshness(spark, str(tmp_path), 3, today)


def test_freshness_without_data(spark, tmp_path):
    with pytest.raises(QualityError, match="No bronze data"):
        check_bronze_freshness(spark, str(tmp_path))


def test_freshness_without_a_date(spark, tmp_path):
    rows = sample_prices(spark).withColumn("ingested_at", F.lit(None).cast("string"))
    append_bronze(rows, str(tmp_path), PRICES_FEED)
    with pytest.raises(QualityError, match="no ingestion date"):
        check_bronze_freshness(spark, str(tmp_path))


def test_freshness_reads_only_one_column(spark, tmp_path):
    append_bronze(sample_prices(spark), str(tmp_path), PRICES_FEED)
    rows = spark.read.parquet(f"{tmp_path}/{PRICES_FEED.table}")
    assert "ReadSchema: struct<ingested_at:string>" in plan_of(freshness(rows, F.current_date(), 3))


@pytest.mark.parametrize("count, passes", [(1, False), (2, True), (20, True), (21, False)])
def test_ticker_count_bounds_are_inclusive(spark, count, passes):
    if passes:
        assert f"{count} tickers" in check_ticker_count(tickers(spark, count))
    else:
        with pytest.raises(QualityError, match=f"^{count} tickers on"):
            check_ticker_count(tickers(spark, count))


@pytest.mark.parametrize("column", ["open_price", "high_price", "low_price", "close_price"])
def test_any_negative_price_is_found(spark, column):
    df = stocks(spark, [("A", "2026-01-05", 0), ("B", "2026-01-05", 1)])
    check_no_negative_prices(df)
    below = df.withColumn(column, F.col(column) - F.when(F.col("ticker") == "A", 1).otherwise(0))
    with pytest.raises(QualityError, match="1 rows hold"):
        check_no_negative_prices(below.select(df.columns))


def test_suite_stops_at_the_first_failure(spark, tmp_path):
    few = tickers(spark, 1)
    with pytest.raises(QualityError, match="No bronze data"):
        run_checks(spark, str(tmp_path), few)
    append_bronze(sample_prices(spark), str(tmp_path), PRICES_FEED)
    with pytest.raises(QualityError, match="tickers on"):
        run_checks(spark, str(tmp_path), few)
    assert len(run_checks(spark, str(tmp_path), tickers(spark, 5))) == 3


def test_gate_job_exit_status(spark, tmp_path, capsys):
    assert gate.main(["--bronze-path", str(tmp_path)]) == 1
    assert "No bronze data" in capsys.readouterr().out
    append_bronze(sample_prices(spark, date.today() - timedelta(days=10)), str(tmp_path), PRICES_FEED)
    assert gate.main(["--bronze-path", str(tmp_path)]) == 1
    assert "days stale" in capsys.readouterr().out
    assert gate.main(["--bronze-path", str(tmp_path), "--max-days-stale", "10"]) == 0
    assert "Freshness OK" in capsys.readouterr().out


def test_report_measures_without_raising(spark):
    prices = tickers(spark, 21).withColumn("low_price", F.lit(-1).cast("decimal(18,4)"))
    bronze = sample_prices(spark, date(2026, 1, 1))
    report = check_report(bronze, prices, F.lit(date(2026, 1, 5)))
    assert tuples(report, "check", "measured", "passed") == [
        ("freshness", 4, False), ("negative_prices", 22, False), ("ticker_count", 21, False),
    ]
    empty = check_report(bronze.limit(0), prices.limit(0), F.lit(date(2026, 1, 5)))
    assert tuples(empty, "check", "measured", "passed") == [
        ("freshness", None, False), ("negative_prices", 0, True), ("ticker_count", 0, False),
    ]
