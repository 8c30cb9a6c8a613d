from __future__ import annotations

from decimal import Decimal

import pytest
from helpers import at, bar, day, macro_bronze, price_bronze, tuples
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.plans.silver import (
    dim_company,
    parse_prices,
    stg_macro_indicators,
    stg_stock_prices,
)
from tidemark.schemas import COMPANY_SNAPSHOT, MACRO_INDICATORS, PRICES_FEED, STOCK_PRICES
from tidemark.sources.bronze import read_any_bronze


def fields(schema):
    return [(f.name, f.dataType) for f in schema.fields]


def test_prices_follow_the_contract(spark):
    bronze = price_bronze(spark, [("A", {"2026-01-05": bar("12.34567")}, "2026-01-06T00:00:00")])
    result = stg_stock_prices(bronze)
    assert fields(result.schema) == fields(STOCK_PRICES)
    row = result.first()
    assert row["close_price"] == Decimal("12.3457")  # half up to four digits
    assert row["trade_date"] == day("2026-01-05")
    assert row["last_updated_at"] == at("2026-01-06")


def test_newer_ingestion_wins_and_older_days_survive(spark):
    bronze = price_bronze(
        spark,
        [
            ("A", {"2026-01-05": bar(1), "2026-01-06": bar(2)}, "2026-01-06T22:00:00+00:00"),
            ("A", {"2026-01-06": bar(20), "2026-01-07": bar(30)}, "2026-01-07T22:00:00+00:00"),
            ("B", {"2026-01-06": bar(7)}, "2026-01-06T22:00:00+00:00"),
        ],
    )
    assert tuples(stg_stock_prices(bronze), "ticker", "trade_date", "close_price") == [
        ("A", day("2026-01-05"), Decimal("1.0000")),
        ("A", day("2026-01-06"), Decimal("20.0000")),
        ("A", day("2026-01-07"), Decimal("30.0000")),
        ("B", day("2026-01-06"), Decimal("7.0000")),
    ]


@pytest.mark.parametrize("partitions", [1, 3, 7])
def test_ties_do_not_depend_on_partitioning(spark, partitions):
    rows = [("A", {"2026-01-05": bar(c)}, "2026-01-06T00:00:00") for c in (5, 9, 3, 9, 1)]
    result = stg_stock_prices(price_bronze(spark, rows).repartition(partitions))
    assert tuples(result, "close_price") == [(Decimal("9.0000"),)]


def test_missing_ingestion_time_loses(spark):
    rows = [("A", {"2026-01-05": bar(9)}, None), ("A", {"2026-01-05": bar(1)}, "2026-01-06T00:00:00")]
    assert tuples(stg_stock_prices(price_bronze(spark, rows)), "close_price") == [(Decimal(1),)]


def test_volume_spellings(spark):
    rows = [
        ("A", {"2026-01-05": bar(1, "5.7")}, "2026-01-06T00:00:00"),
        ("B", {"2026-01-05": bar(1, "1e3")}, "2026-01-06T00:00:00"),
        ("C", {"2026-01-05": bar(1, "9000000000")}, "2026-01-06T00:00:00"),
    ]
    result = stg_stock_prices(price_bronze(spark, rows))
    assert tuples(result, "ticker", "volume") == [("A", 6), ("B", 1000), ("C", 9_000_000_000)]


def test_numbers_instead_of_texts_in_the_payload(spark):
    numeric = {k: float(v) if k != "5. volume" else 7 for k, v in bar("3.5").items()}
    bronze = price_bronze(spark, [("A", {"2026-01-05": numeric}, "2026-01-06T00:00:00")])
    assert tuples(stg_stock_prices(bronze), "close_price", "volume") == [(Decimal("3.5000"), 7)]


def test_empty_series_yields_no_rows(spark):
    assert stg_stock_prices(price_bronze(spark, [("A", {}, "2026-01-06T00:00:00")])).isEmpty()


@pytest.mark.parametrize("close, when", [("abc", "2026-01-05"), ("1", "no date")])
def test_unusable_price_values_fail(spark, close, when):
    broken = {**bar(1), "4. close": close}
    bronze = price_bronze(spark, [("A", {when: broken}, "2026-01-06T00:00:00")])
    with pytest.raises(PySparkException):
        stg_stock_prices(bronze).collect()


def test_broken_json_fails_instead_of_vanishing(spark):
    bronze = spark.createDataFrame(
        [("A", '{"Time Series (Daily)": {', "2026-01-06T00:00:00")],
        "ticker string, raw_payload string, ingested_at string",
    )
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        parse_prices(bronze).collect()


def test_struct_payloads_whose_keys_differ_by_day(spark, tmp_path):
    """Each day's struct has that day's dates as fields; nothing is lost, nothing invented."""
    days = {"2026-01-06": ("2026-01-05", "2026-01-06"), "2026-01-07": ("2026-01-06", "2026-01-07")}
    for ingest, dates in days.items():
        fields_of = ["1. open", "2. high", "3. low", "4. close", "5. volume"]
        one = F.struct(*[F.lit(str(i + 1)).alias(n) for i, n in enumerate(fields_of)])
        payload = F.struct(F.struct(*[one.alias(d) for d in dates]).alias("Time Series (Daily)"))
        spark.range(1).select(
            F.lit("A").alias("ticker"),
            payload.alias("raw_payload"),
            F.lit(f"{ingest}T00:00:00").alias("ingested_at"),
        ).write.parquet(f"{tmp_path}/{PRICES_FEED.table}/ingest_date={ingest}")
    bronze = read_any_bronze(spark, str(tmp_path), PRICES_FEED, f"{tmp_path}/w")
    assert parse_prices(bronze).count() == 4
    assert tuples(stg_stock_prices(bronze), "trade_date", "last_updated_at") == [
        (day("2026-01-05"), at("2026-01-06")),
        (day("2026-01-06"), at("2026-01-07")),
        (day("2026-01-07"), at("2026-01-07")),
    ]


def test_macro_values(spark):
    points = [
        ("2026-01-01", "1.5"),
        ("2026-02-01", "."),
        ("2026-03-01", None),
        ("2026-04-01", "abc"),
        ("2026-05-01", "1e3"),
    ]
    result = stg_macro_indicators(macro_bronze(spark, [("GDP", points, "2026-06-01T00:00:00")]))
    assert fields(result.schema) == fields(MACRO_INDICATORS)
    assert tuples(result, "observation_date", "value") == [
        (day("2026-01-01"), Decimal("1.5000")),
        (day("2026-05-01"), Decimal("1000.0000")),
    ]


def test_a_missing_value_does_not_replace_an_older_real_one(spark):
    rows = [
        ("GDP", [("2026-01-01", "5")], "2026-06-01T00:00:00"),
        ("GDP", [("2026-01-01", ".")], "2026-06-02T00:00:00"),
    ]
    assert tuples(stg_macro_indicators(macro_bronze(spark, rows)), "value") == [(Decimal(5),)]


def test_relanding_the_same_bronze_changes_nothing(spark):
    bronze = price_bronze(
        spark,
        [("A", {"2026-01-05": bar(1), "2026-01-06": bar(2)}, "2026-01-06T00:00:00")] * 2,
    )
    once, twice = stg_stock_prices(bronze), stg_stock_prices(bronze.union(bronze))
    assert tuples(once, "*") == tuples(twice, "*")


def test_company_view(spark):
    snapshot = spark.createDataFrame(
        [
            ("A", "a", "Tech", "X", day("2026-01-01"), "i", at("2026-01-01"), at("2026-01-01"), at("2026-02-01")),
            ("A", "a", "Health", "X", day("2026-01-01"), "j", at("2026-02-01"), at("2026-02-01"), None),
        ],
        COMPANY_SNAPSHOT,
    )
    view = dim_company(snapshot)
    assert view.columns == [
        "ticker", "company_name", "sector", "exchange", "effective_date", "valid_from", "valid_to",
        "is_current",
    ]
    assert tuples(view, "sector", "valid_to", "is_current") == [
        ("Health", at("9999-12-31T23:59:59"), True),
        ("Tech", at("2026-02-01"), False),
    ]
