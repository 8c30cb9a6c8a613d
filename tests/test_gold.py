from __future__ import annotations

import statistics
from datetime import timedelta
from decimal import Decimal

import pytest
from helpers import at, day, stocks, tuples
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.operators.aggregates import pivot_series
from tidemark.operators.temporal import asof_join, pit_join
from tidemark.plans import consumer
from tidemark.plans.gold import daily_price_summary, macro_market_correlation, sector_performance
from tidemark.schemas import MACRO_INDICATORS

COMPANY = "ticker string, sector string, valid_from timestamp, valid_to timestamp"
END = at("9999-12-31T23:59:59")


def series(spark, closes, ticker="A", start="2026-01-01"):
    first = day(start)
    return stocks(
        spark,
        [(ticker, (first + timedelta(days=i)).isoformat(), c) for i, c in enumerate(closes)],
    )


def indicators(spark, rows):
    data = [(s, day(d), Decimal(v), at("2026-01-01")) for s, d, v in rows]
    return spark.createDataFrame(data, MACRO_INDICATORS)


def test_summary_types(spark):
    types = dict(daily_price_summary(series(spark, [1, 2])).dtypes)
    assert types["ma_7d"] == types["volatility_30d"] == types["daily_return_pct"] == "double"
    assert types["daily_change"] == "decimal(19,4)"
    assert types["volume"] == "bigint"


def test_first_row_of_a_ticker(spark):
    row = daily_price_summary(series(spark, [10])).first()
    assert (row["ma_7d"], row["ma_30d"]) == (10.0, 10.0)
    assert row["volatility_30d"] is None
    assert row["daily_change"] is None and row["daily_return_pct"] is None


def test_frames_count_rows_and_grow_from_partial_prefixes(spark):
    closes = [100 + (7 * i) % 13 for i in range(45)]
    # Gaps between days do not matter: a frame is a number of rows.
    first = day("2026-01-01")
    rows = [("A", (first + timedelta(days=3 * i)).isoformat(), c) for i, c in enumerate(closes)]
    result = daily_price_summary(stocks(spark, rows)).orderBy("trade_date").collect()
    for i, row in enumerate(result):
        week, month = closes[max(0, i - 6) : i + 1], closes[max(0, i - 29) : i + 1]
        assert row["ma_7d"] == pytest.approx(statistics.fmean(week))
        assert row["ma_30d"] == pytest.approx(statistics.fmean(month))
        if i:
            assert row["volatility_30d"] == pytest.approx(statistics.stdev(month))
            assert row["daily_change"] == closes[i] - closes[i - 1]
            expected = (closes[i] - closes[i - 1]) / closes[i - 1] * 100
            assert row["daily_return_pct"] == pytest.approx(expected)


def test_return_needs_a_positive_previous_close(spark):
    result = daily_price_summary(series(spark, [0, 5, -2, 4])).orderBy("trade_date").collect()
    assert [r["daily_change"] for r in result] == [None, 5, -7, 6]
    assert [r["daily_return_pct"] for r in result] == [None, None, -140.0, None]


def test_tickers_do_not_mix(spark):
    both = series(spark, [1, 2], "A").union(series(spark, [10, 30], "B"))
    result = daily_price_summary(both)
    assert tuples(result, "ticker", "ma_7d") == [("A", 1.0), ("A", 1.5), ("B", 10.0), ("B", 20.0)]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.decimals(min_value=0, max_value=10**13, places=4), min_size=1, max_size=40))
def test_moving_average_is_exact(spark, closes):
    rows = daily_price_summary(series(spark, closes)).orderBy("trade_date").collect()
    for i, row in enumerate(rows):
        window = closes[max(0, i - 6) : i + 1]
        assert row["ma_7d"] == float(sum(window)) / len(window)


def test_change_day_uses_the_new_sector(spark):
    company = spark.createDataFrame(
        [
            ("A", "Tech", at("2026-01-01T09:30:00"), at("2026-01-10T15:00:00")),
            ("A", "Health", at("2026-01-10T15:00:00"), END),
        ],
        COMPANY,
    )
    facts = stocks(spark, [("A", f"2026-01-{d:02d}", 1) for d in (1, 9, 10, 11)])
    joined = pit_join(facts, company, key="ticker", date="trade_date")
    assert tuples(joined, "trade_date", "sector") == [
        (day("2026-01-01"), "Tech"),  # bounds are days: the hour of the change does not matter
        (day("2026-01-09"), "Tech"),
        (day("2026-01-10"), "Health"),
        (day("2026-01-11"), "Health"),
    ]


def test_versions_that_match_nothing(spark):
    company = spark.createDataFrame(
        [
            ("A", "Tech", at("2026-01-05T08:00:00"), at("2026-01-05T20:00:00")),
            ("A", "Health", at("2026-01-06T08:00:00"), END),
        ],
        COMPANY,
    )
    facts = stocks(spark, [("A", "2026-01-04", 1), ("A", "2026-01-05", 1), ("Z", "2026-01-06", 1)])
    # Before the first version; on the only day of a one-day version; no version at all.
    assert pit_join(facts, company, key="ticker", date="trade_date").isEmpty()


def test_sector_performance(spark):
    prices = series(spark, [100, 110], "A").union(series(spark, [50, 40], "B")).union(
        series(spark, [7, 7], "C")
    )
    company = spark.createDataFrame(
        [(t, s, at("2026-01-01"), END) for t, s in (("A", "Tech"), ("B", "Tech"), ("C", "Energy"))],
        COMPANY,
    )
    result = sector_performance(daily_price_summary(prices), company)
    assert tuples(result, "trade_date", "sector", "num_companies", "avg_daily_return_pct",
                  "total_volume", "avg_close_price", "min_close_price", "max_close_price") == [
        (day("2026-01-01"), "Energy", 1, None, 10, 7.0, Decimal(7), Decimal(7)),
        (day("2026-01-01"), "Tech", 2, None, 20, 75.0, Decimal(50), Decimal(100)),
        (day("2026-01-02"), "Energy", 1, 0.0, 10, 7.0, Decimal(7), Decimal(7)),
        (day("2026-01-02"), "Tech", 2, -5.0, 20, 75.0, Decimal(40), Decimal(110)),
    ]


def test_pivot_keeps_dates_with_a_single_series(spark):
    rows = [("GDP", "2026-01-01", "9"), ("UNRATE", "2026-01-01", "4"), ("GDP", "2026-04-01", "8")]
    result = pivot_series(indicators(spark, rows + [("OTHER", "2026-05-01", "1")]))
    assert tuples(result, "observation_date", "fed_funds_rate", "cpi", "unemployment_rate", "gdp") == [
        (day("2026-01-01"), None, None, Decimal(4), Decimal(9)),
        (day("2026-04-01"), None, None, None, Decimal(8)),
        (day("2026-05-01"), None, None, None, None),
    ]


def test_asof_is_inclusive_and_keeps_every_left_row(spark):
    left = spark.createDataFrame(
        [(day(d), i) for i, d in enumerate(
            ["2026-01-01", "2026-01-05", "2026-01-06", "2026-02-09", "2026-02-10", "2027-01-01"])]
        + [(None, 99)],
        "d date, i int",
    )
    right = spark.createDataFrame(
        [(day("2026-01-05"), "x"), (day("2026-02-10"), None)], "seen date, v string"
    )
    assert tuples(asof_join(left, right, "d", "seen"), "i", "seen", "v") == [
        (0, None, None),
        (1, day("2026-01-05"), "x"),
        (2, day("2026-01-05"), "x"),
        (3, day("2026-01-05"), "x"),
        (4, day("2026-02-10"), None),
        (5, day("2026-02-10"), None),
        (99, None, None),
    ]


def test_asof_with_nothing_on_the_right(spark):
    left = spark.createDataFrame([(day("2026-01-01"),)], "d date")
    right = spark.createDataFrame([], "seen date, v string")
    assert tuples(asof_join(left, right, "d", "seen"), "d", "seen", "v") == [
        (day("2026-01-01"), None, None)
    ]


days_of_year = st.integers(0, 400)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(days_of_year, min_size=1, max_size=30), st.sets(days_of_year, max_size=10))
def test_asof_equals_brute_force(spark, lefts, rights):
    base = day("2026-01-01")
    left = spark.createDataFrame([(i, base + timedelta(d)) for i, d in enumerate(lefts)], "i int, d date")
    right = spark.createDataFrame([(base + timedelta(d), d) for d in rights], "seen date, v int")
    expected = [(i, max((r for r in rights if r <= d), default=None)) for i, d in enumerate(lefts)]
    assert tuples(asof_join(left, right, "d", "seen"), "i", "v") == expected


def test_market_takes_the_latest_date_of_any_series(spark):
    """A quarter date on which only GDP was observed hides the monthly series; no carry forward."""
    macro = indicators(
        spark,
        [("FEDFUNDS", "2026-03-01", "5.5"), ("GDP", "2026-01-01", "27000"), ("GDP", "2026-04-01", "27500")],
    )
    prices = stocks(spark, [("A", "2025-12-31", 1, 3), ("A", "2026-03-05", 2, 4), ("A", "2026-08-20", 1, 5),
                            ("B", "2026-08-20", 6, 6)])
    result = macro_market_correlation(daily_price_summary(prices), macro)
    assert tuples(result, "trade_date", "market_avg_return", "market_total_volume", "num_tickers",
                  "fed_funds_rate", "gdp", "macro_observation_date") == [
        (day("2025-12-31"), None, 3, 1, None, None, None),
        (day("2026-03-05"), 100.0, 4, 1, Decimal("5.5"), None, day("2026-03-01")),
        (day("2026-08-20"), -50.0, 11, 2, None, Decimal(27500), day("2026-04-01")),
    ]


def test_consumer_queries_sort_and_limit(spark):
    prices = series(spark, range(1, 15), "A").union(series(spark, range(1, 15), "B"))
    summary = daily_price_summary(prices)
    top = consumer.top_recent_prices(summary).collect()
    assert [(r["trade_date"], r["ticker"]) for r in top[:3]] == [
        (day("2026-01-14"), "A"), (day("2026-01-14"), "B"), (day("2026-01-13"), "A"),
    ]
    assert len(top) == 10
    history = consumer.ticker_history(summary, "B").collect()
    assert [r["trade_date"].day for r in history] == list(range(14, 4, -1))


def test_missing_closes_are_left_out_of_averages(spark):
    closes = [10, None, 30] + [None] * 8 + [5]
    rows = daily_price_summary(series(spark, closes)).orderBy("trade_date").collect()
    assert [r["ma_7d"] for r in rows] == [10, 10, 20, 20, 20, 20, 20, 30, 30, None, None, 5]
    assert rows[11]["ma_30d"] == 15.0
    assert daily_price_summary(series(spark, [None])).first()["ma_7d"] is None
