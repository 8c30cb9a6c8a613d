from __future__ import annotations

import json
from datetime import date, datetime, timezone

import pytest
from helpers import tuples

from tidemark.plans.silver import stg_macro_indicators, stg_stock_prices
from tidemark.schemas import MACRO_FEED, PRICES_FEED
from tidemark.sources.bronze import (
    IngestionError,
    bronze_exists,
    land,
    list_partitions,
    read_bronze,
    read_rejected,
    read_staged,
    with_envelope_error,
)
from tidemark.sources.samples import main as write_samples_main
from tidemark.sources.samples import sample_macro, sample_prices, write_samples
from tidemark.sources.seeds import read_seed
from tidemark.streaming.landing_stream import stream_landing, stream_staged

GOOD = {"Meta Data": {"2. Symbol": "A"}, "Time Series (Daily)": {}}
STAMP = datetime(2026, 1, 5, 22, 15, tzinfo=timezone.utc)


def responses(spark, feed, rows):
    data = [(key, body if isinstance(body, str) else json.dumps(body)) for key, body in rows]
    return spark.createDataFrame(data, f"{feed.key} string, raw_payload string")


@pytest.mark.parametrize(
    "body, reason",
    [
        (GOOD, None),
        ({"Time Series (Daily)": None}, None),  # the key counts, not its value
        ({"Note": "slow down"}, "slow down"),
        ({"Error Message": "Invalid API call"}, "Invalid API call"),
        ({"Information": "premium endpoint"}, "premium endpoint"),
        ({"Information": "i", "Error Message": "e", "Note": "n"}, "n"),
        ({"Note": "", "Information": "i"}, "i"),
        ({}, "Unknown error"),
        ({"Meta Data": {"Time Series (Daily)": {}}}, "Unknown error"),  # nested does not count
        ("<html>", "Unknown error"),
    ],
)
def test_price_envelopes(spark, body, reason):
    row = with_envelope_error(responses(spark, PRICES_FEED, [("A", body)]), PRICES_FEED).first()
    assert row["error"] == (f"Unexpected response for A: {reason}" if reason else None)


@pytest.mark.parametrize(
    "body, reason",
    [
        ({"observations": []}, None),
        ({"error_message": "Bad Request"}, "Bad Request"),
        ({}, "Unknown error"),
    ],
)
def test_macro_envelopes(spark, body, reason):
    row = with_envelope_error(responses(spark, MACRO_FEED, [("GDP", body)]), MACRO_FEED).first()
    assert row["error"] == (f"Unexpected response for GDP: {reason}" if reason else None)


def test_landing_keeps_the_payload_and_adds_metadata(spark, tmp_path):
    bronze, text = str(tmp_path), '{"Time Series (Daily)":   {}, "x": [1,  2]}'
    report = land(responses(spark, PRICES_FEED, [("A", text)]), bronze, PRICES_FEED, STAMP)
    assert (report.landed, report.rejected) == (1, 0)
    assert (tmp_path / PRICES_FEED.table / "ingest_date=2026-01-05").is_dir()
    row = read_bronze(spark, bronze, PRICES_FEED).first()
    assert row.asDict() == {
        "ticker": "A",
        "raw_payload": text,
        "ingested_at": "2026-01-05T22:15:00+00:00",
        "source": "alpha_vantage",
        "api_function": "TIME_SERIES_DAILY",
        "ingest_date": date(2026, 1, 5),
    }


def test_macro_rows_have_no_api_function(spark, tmp_path):
    land(responses(spark, MACRO_FEED, [("GDP", {"observations": []})]), str(tmp_path), MACRO_FEED, STAMP)
    assert read_bronze(spark, str(tmp_path), MACRO_FEED).columns == [
        "series_id", "raw_payload", "ingested_at", "source", "ingest_date",
    ]


def test_landing_appends(spark, tmp_path):
    for _ in range(2):
        land(responses(spark, PRICES_FEED, [("A", GOOD)]), str(tmp_path), PRICES_FEED, STAMP)
    assert read_bronze(spark, str(tmp_path), PRICES_FEED).count() == 2


def test_some_failed_tickers_are_set_aside(spark, tmp_path):
    mixed = responses(spark, PRICES_FEED, [("A", GOOD), ("B", {"Note": "n"}), ("C", "broken")])
    report = land(mixed, str(tmp_path), PRICES_FEED, STAMP)
    assert (report.landed, report.rejected) == (1, 2)
    assert tuples(read_rejected(spark, str(tmp_path), PRICES_FEED), "ticker", "error") == [
        ("B", "Unexpected response for B: n"),
        ("C", "Unexpected response for C: Unknown error"),
    ]


def test_all_failed_tickers_fail_the_run(spark, tmp_path):
    with pytest.raises(IngestionError, match="All 2 "):
        land(responses(spark, PRICES_FEED, [("A", {}), ("B", {})]), str(tmp_path), PRICES_FEED)


def test_any_failed_series_fails_the_run(spark, tmp_path):
    rows = [("GDP", {"observations": []}), ("CPI", {"error_message": "e"})]
    with pytest.raises(IngestionError, match="1 responses"):
        land(responses(spark, MACRO_FEED, rows), str(tmp_path), MACRO_FEED)
    assert read_bronze(spark, str(tmp_path), MACRO_FEED).count() == 1


def test_staged_files(spark, tmp_path):
    for name in ("AAPL.json", "MSFT_221500.json", "BRK_B_221501.json", "notes.txt"):
        (tmp_path / name).write_text(json.dumps(GOOD, indent=2))
    staged = read_staged(spark, str(tmp_path), PRICES_FEED)
    assert [row[0] for row in tuples(staged, "ticker")] == ["AAPL", "BRK_B", "MSFT"]
    assert json.loads(staged.first()["raw_payload"]) == GOOD


def test_partition_listing(spark, tmp_path):
    for day in ("2026-01-07", "2026-01-05"):
        spark.range(3).coalesce(1).write.parquet(f"{tmp_path}/t/ingest_date={day}")
    spark.range(1).write.parquet(f"{tmp_path}/t/other")
    assert [r[0] for r in list_partitions(spark, f"{tmp_path}/t").collect()] == [
        "2026-01-05", "2026-01-07",
    ]


def test_seed_file(spark, tmp_path):
    file = tmp_path / "company_metadata.csv"
    file.write_text(
        "ticker,company_name,sector,exchange,effective_date\n"
        'JNJ,"Johnson, Johnson",Health Care,NYSE,2026-08-01\n'
    )
    assert tuples(read_seed(spark, str(file)), "*") == [
        ("JNJ", "Johnson, Johnson", "Health Care", "NYSE", date(2026, 8, 1))
    ]


def test_samples_follow_the_bronze_contract(spark):
    prices, macro = sample_prices(spark), sample_macro(spark)
    assert set(prices.columns) == {*PRICES_FEED.columns, "ingest_date"}
    assert set(macro.columns) == {*MACRO_FEED.columns, "ingest_date"}
    assert {r["ingest_date"] for r in prices.collect()} == {date.today()}
    payload = json.loads(prices.filter("ticker = 'MSFT'").first()["raw_payload"])
    assert payload["Meta Data"]["2. Symbol"] == "MSFT"
    assert payload["Time Series (Daily)"]["2026-08-22"] == {
        "1. open": "154.0", "2. high": "156.0", "3. low": "152.0", "4. close": "155.0",
        "5. volume": "1020000",
    }


def test_sample_stamp_matches_its_partition(spark):
    day = date(2026, 1, 15)
    for df in (sample_prices(spark, day), sample_macro(spark, day)):
        stamps = df.selectExpr("cast(cast(ingested_at as timestamp) as date) d", "ingest_date")
        assert tuples(stamps.distinct(), "*") == [(day, day)]


def test_samples_build_silver(spark, tmp_path):
    assert not bronze_exists(spark, str(tmp_path), PRICES_FEED)
    write_samples(spark, str(tmp_path), date(2026, 9, 1))
    assert bronze_exists(spark, str(tmp_path), PRICES_FEED)
    assert stg_stock_prices(read_bronze(spark, str(tmp_path), PRICES_FEED)).count() == 30
    assert stg_macro_indicators(read_bronze(spark, str(tmp_path), MACRO_FEED)).count() == 11


def test_sample_job_scales_by_ticker_count(spark, tmp_path):
    assert sample_prices(spark, tickers=1000, days=3).count() == 1000
    assert write_samples_main(["--output-root", str(tmp_path), "--ingest-date", "2026-01-15"]) == 0
    assert (tmp_path / "daily_prices_raw" / "ingest_date=2026-01-15").is_dir()


def test_landing_nothing(spark, tmp_path):
    for empty in (
        responses(spark, PRICES_FEED, [("A", GOOD)]).limit(0),
        responses(spark, PRICES_FEED, [("A", GOOD)]).filter("ticker = 'B'"),
        spark.createDataFrame([], "ticker string, raw_payload string"),
    ):
        report = land(empty, str(tmp_path), PRICES_FEED, STAMP)
        assert (report.landed, report.rejected) == (0, 0)
    assert not bronze_exists(spark, str(tmp_path), PRICES_FEED)


def test_a_batch_that_is_tried_again_lands_once(spark, tmp_path):
    """Whatever part of it was written before; repeats within a batch stay, another day is another day."""
    bronze, first, second = str(tmp_path), datetime(2026, 1, 5, 1, tzinfo=timezone.utc), datetime(2026, 1, 5, 9, tzinfo=timezone.utc)
    good, bad = '{"Time Series (Daily)": {}}', '{"Note": "limit"}'
    rows = [("A", good), ("A", good), ("B", good), ("C", bad), (None, bad), ("D", None)]
    batch = spark.createDataFrame(rows, "ticker string, raw_payload string")

    def counts():
        return read_bronze(spark, bronze, PRICES_FEED).count(), read_rejected(spark, bronze, PRICES_FEED).count()

    land(batch.filter("ticker IN ('B', 'C')"), bronze, PRICES_FEED, first, once=True)
    for stamp in (first, second):
        report = land(batch, bronze, PRICES_FEED, stamp, once=True)
        assert (report.landed, report.rejected) == (3, 3) and counts() == (3, 3)
    land(batch, bronze, PRICES_FEED, datetime(2026, 1, 6, tzinfo=timezone.utc), once=True)
    assert counts() == (6, 6)


def test_staged_files_land_as_a_stream(spark, tmp_path):
    """Two sinks, counts over all batches, the policy on those counts, and nothing twice."""
    staged, bronze, moment = tmp_path / "staged", f"{tmp_path}/b", datetime(2026, 1, 5, tzinfo=timezone.utc)
    staged.mkdir()
    for name in "ABCDE":
        payload = '{"observations": []}' if name < "D" else '{"error_message": "no"}'
        (staged / f"{name}_221500.json").write_text(payload)

    def run():
        arriving = stream_staged(spark, str(staged), MACRO_FEED, max_files_per_trigger=2)
        return stream_landing(arriving, bronze, MACRO_FEED, f"{tmp_path}/checkpoint", moment)

    with pytest.raises(IngestionError, match="2 responses failed"):
        run()
    assert sorted(r.series_id for r in read_bronze(spark, bronze, MACRO_FEED).collect()) == ["A", "B", "C"]
    assert sorted(r.series_id for r in read_rejected(spark, bronze, MACRO_FEED).collect()) == ["D", "E"]
    (staged / "F.json").write_text('{"observations": []}')
    report = run()
    assert (report.landed, report.rejected) == (1, 0)
