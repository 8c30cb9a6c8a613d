"""The physical plans and the behaviour under skew that large inputs depend on."""

from __future__ import annotations

import re
from datetime import datetime

import pyarrow.parquet as pq
import pytest
from helpers import at, day, plan_of, tuples
from pyspark.sql import functions as F

from tidemark.operators.dedup import latest_by
from tidemark.operators.frames import row_frames
from tidemark.operators.temporal import asof_join, pit_join
from tidemark.plans.gold import daily_price_summary, sector_performance
from tidemark.plans.silver import stg_macro_indicators, stg_stock_prices
from tidemark.schemas import MACRO_FEED, PRICE, PRICES_FEED, STOCK_PRICES
from tidemark.sources.bronze import append_bronze, read_bronze
from tidemark.sources.samples import sample_macro, sample_prices
from tidemark.sources.tables import MONTHLY, PERIOD, Warehouse, laid_out, with_period

import __spark_entry__ as entry
from workload import feeds, registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def bronze(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("bronze"))
    append_bronze(sample_prices(spark, tickers=50), root, PRICES_FEED)
    append_bronze(sample_macro(spark), root, MACRO_FEED)
    return root


@pytest.fixture
def stored_prices(spark, tmp_path):
    path = f"{tmp_path}/prices"
    spark.createDataFrame([], STOCK_PRICES).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("name", list(registry.registered()))
def test_every_query_has_sql(name):
    assert name in entry.oracle_sql()


PURE = [
    "stg_stock_prices", "stg_macro_indicators", "dim_company", "daily_price_summary",
    "sector_performance", "macro_market_correlation", "latest_by_key", "pit_join", "asof_join",
    "market_daily", "macro_pivot", "bronze_envelope", "json_extract",
]


@pytest.mark.parametrize("name", PURE)
def test_no_python_and_no_cross_product(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF))
    for operator in ("Python", "Pandas", "ArrowEval", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in plan


def test_deduplication_limits_rows_before_the_shuffle(spark, bronze):
    plan = plan_of(stg_stock_prices(read_bronze(spark, bronze, PRICES_FEED)))
    assert plan.count("WindowGroupLimit") == 2
    assert plan.rindex("WindowGroupLimit") > plan.rindex("Exchange hashpartitioning")
    plan = plan_of(stg_macro_indicators(read_bronze(spark, bronze, MACRO_FEED)))
    assert plan.rindex("WindowGroupLimit") > plan.rindex("Exchange hashpartitioning")


def test_silver_scan_reads_only_what_it_needs(spark, bronze):
    plan = plan_of(stg_stock_prices(read_bronze(spark, bronze, PRICES_FEED)))
    assert "ReadSchema: struct<ticker:string,raw_payload:string,ingested_at:string>" in plan
    recent = read_bronze(spark, bronze, PRICES_FEED).filter("ingest_date >= '2026-01-16'")
    assert "PartitionFilters: [isnotnull(ingest_date" in plan_of(stg_stock_prices(recent))


def test_rolling_metrics_take_one_shuffle_and_one_sort(spark, stored_prices):
    plan = plan_of(daily_price_summary(stored_prices))
    assert plan.count("Exchange") == 1 and plan.count("Sort [") == 1


def test_ticker_filter_reaches_the_scan(spark, stored_prices):
    plan = plan_of(daily_price_summary(stored_prices).filter("ticker = 'A'"))
    assert "EqualTo(ticker,A)" in plan


def test_sector_mart_reuses_the_partitioning_of_the_window(spark, stored_prices):
    company = spark.createDataFrame(
        [("A", "Tech", at("2026-01-01"), at("2027-01-01"))],
        "ticker string, sector string, valid_from timestamp, valid_to timestamp",
    )
    plan = plan_of(sector_performance(daily_price_summary(stored_prices), company))
    assert "SortMergeJoin" in plan
    # Facts by ticker for the window, the dimension by ticker, the aggregate: no fourth.
    assert plan.count("Exchange hashpartitioning") == 3


# --- skew: one key holds a third of all rows or more --------------------------------------------

ROWS = 200_000


def skewed(spark, key="A"):
    """A third of the rows share one key and one day."""
    hot = F.col("id") % 3 == 0
    return spark.range(ROWS, numPartitions=16).select(
        "id",
        F.when(hot, key).otherwise(F.concat(F.lit("T"), (F.col("id") % 500).cast("string"))).alias("ticker"),
        F.when(hot, F.lit(day("2026-06-01")))
        .otherwise(F.date_add(F.lit(day("2026-01-01")), (F.col("id") % 300).cast("int")))
        .alias("trade_date"),
    )


def test_deduplication_of_a_hot_key(spark):
    rows = skewed(spark).withColumn("seen", F.timestamp_seconds("id"))
    result = latest_by(rows, ["ticker", "trade_date"], "seen", ["id"])
    expected = rows.groupBy("ticker", "trade_date").agg(F.max("id").alias("id"))
    assert tuples(result, "ticker", "trade_date", "id") == tuples(
        expected, "ticker", "trade_date", "id"
    )


def test_pit_join_of_a_hot_ticker_keeps_every_row(spark):
    company = spark.createDataFrame(
        [("A", "Tech", datetime(2026, 1, 1), datetime(2026, 6, 1)),
         ("A", "Health", datetime(2026, 6, 1), datetime(9999, 12, 31))]
        + [(f"T{i}", "Energy", datetime(2026, 1, 1), datetime(9999, 12, 31)) for i in range(500)],
        "ticker string, sector string, valid_from timestamp, valid_to timestamp",
    )
    joined = pit_join(skewed(spark), company, "ticker", "trade_date")
    hot = (ROWS + 2) // 3
    assert tuples(joined.groupBy("sector").count(), "*") == [
        ("Energy", ROWS - hot), ("Health", hot),
    ]


def test_asof_join_of_a_hot_day_is_not_shuffled(spark):
    right = spark.createDataFrame(
        [(day("2026-03-01"), 1), (day("2026-05-15"), 2)], "seen date, v int"
    )
    joined = asof_join(skewed(spark), right, "trade_date", "seen")
    assert "BroadcastHashJoin" in plan_of(joined)
    assert "Exchange hashpartitioning" not in plan_of(joined)
    expected = (
        skewed(spark)
        .groupBy(
            F.when(F.col("trade_date") >= "2026-05-15", 2)
            .when(F.col("trade_date") >= "2026-03-01", 1)
            .alias("v")
        )
        .count()
    )
    assert tuples(joined.groupBy("v").count(), "*") == tuples(expected, "*")


def test_sector_totals_of_a_hot_day(spark):
    price = F.col("id").cast(PRICE)
    facts = skewed(spark).select(
        "ticker", "trade_date", price.alias("close_price"),
        F.lit(1.0).alias("daily_return_pct"), F.lit(1).cast("bigint").alias("volume"),
    )
    company = spark.createDataFrame(
        [("A", "Tech", datetime(2020, 1, 1), datetime(9999, 12, 31))],
        "ticker string, sector string, valid_from timestamp, valid_to timestamp",
    )
    row = sector_performance(facts, company).first()
    hot = (ROWS + 2) // 3
    assert (row["num_companies"], row["total_volume"]) == (1, hot)
    assert row["avg_close_price"] == sum(range(0, ROWS, 3)) / hot


def test_stored_files_are_sorted_within_and_few(spark, tmp_path):
    """A ticker filter can skip row groups, and a month is one small file, not one per task."""
    rows = skewed(spark).withColumn("period", F.date_format("trade_date", "yyyy-MM"))
    laid_out(rows.repartition(16), ["period"], ["ticker", "trade_date"]).write.partitionBy(
        "period"
    ).parquet(f"{tmp_path}/t")
    files = list((tmp_path / "t").glob("period=*/*.parquet"))
    assert len(files) == len(list((tmp_path / "t").glob("period=*")))
    for file in files[:3]:
        stored = pq.read_table(file, columns=["ticker", "trade_date"]).to_pylist()
        keys = [(row["ticker"], row["trade_date"]) for row in stored]
        assert keys == sorted(keys)


def test_a_hot_period_is_split_over_several_tasks(spark, tmp_path):
    """A third of all rows fall on one day; no task has to write their whole month alone."""
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "256k")
    try:
        rows = skewed(spark).withColumns(
            {"period": F.date_format("trade_date", "yyyy-MM"), "noise": F.md5(F.col("id").cast("string"))}
        )
        laid_out(rows.repartition(16), ["period"], ["ticker"]).write.partitionBy("period").parquet(
            f"{tmp_path}/t"
        )
    finally:
        spark.conf.set(size, before)
    hot = list((tmp_path / "t" / "period=2026-06").glob("*.parquet"))
    assert len(hot) > 3
    assert spark.read.parquet(f"{tmp_path}/t").count() == ROWS


def test_pit_join_splits_a_hot_ticker_when_nothing_is_broadcast(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.shuffle.partitions": "32",
    }
    before = {key: spark.conf.get(key) for key in settings}
    company = spark.range(501).select(
        F.when(F.col("id") == 500, "A").otherwise(F.concat(F.lit("T"), F.col("id"))).alias("ticker"),
        F.lit("Energy").alias("sector"),
        F.lit(datetime(2020, 1, 1)).alias("valid_from"),
        F.lit(datetime(9999, 12, 31)).alias("valid_to"),
    )
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        joined = pit_join(skewed(spark), company, "ticker", "trade_date")
        totals = joined.groupBy("sector").agg(F.count("id"), F.sum("id"))
        assert [tuple(row) for row in totals.collect()] == [("Energy", ROWS, ROWS * (ROWS - 1) // 2)]
        assert "skew=true" in plan_of(totals)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


@pytest.mark.parametrize(
    "name", ["sector_performance", "sector_by_day", "sector_ranking", "market_daily", "macro_market_correlation", "market_by_day"]
)
def test_daily_marts_over_unique_rows_group_by_day_only(spark, name):
    """A distinct count would keep every row of a task in a hash table by (day, ticker)."""
    plan = plan_of(entry.queries()[name](spark, SF))
    assert re.search(r"Aggregate\(keys=\[trade_date", plan)
    assert not re.search(r"Aggregate\(keys=\[[^\]]*ticker", plan)


@pytest.mark.parametrize("feed", [PRICES_FEED, MACRO_FEED])
def test_landing_by_day_neither_shuffles_nor_sorts_payloads(spark, tmp_path, feed):
    make = feeds.price_responses if feed is PRICES_FEED else feeds.macro_responses
    rows = make(spark, SF, by_day=True)
    plan = plan_of(rows)
    assert "Exchange" not in plan and plan.index("raw_payload") < plan.index("Sort [ingest_date")  # printed from the top
    append_bronze(rows, str(tmp_path), feed, by_day=True)
    landed = read_bronze(spark, str(tmp_path), feed)
    assert tuples(landed, *landed.columns) == tuples(make(spark, SF), *landed.columns)
    assert landed.select(F.input_file_name()).distinct().count() <= 28 * rows.rdd.getNumPartitions()
    codecs = {pq.ParquetFile(p).metadata.row_group(0).column(0).compression for p in tmp_path.rglob("*.parquet")}
    assert codecs == {"ZSTD"}


def test_frames_and_metrics_over_them_shuffle_rows_by_key_only(spark, stored_prices):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frames = row_frames(stored_prices, stored_prices.select("ticker", "trade_date"), "ticker", "trade_date", 29)
        plan = plan_of(daily_price_summary(frames, ["dependent"]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("SortMergeJoin") == 1  # the semi join that finds the keys
    assert not re.search(r"Exchange hashpartitioning\([^)]*trade_date", plan)


def test_changed_days_are_found_without_shuffling_rows(spark, tmp_path):
    warehouse = Warehouse(str(tmp_path))

    def put(rows):
        made = spark.createDataFrame(rows, "ticker string, trade_date date, volume long")
        warehouse.replace(with_period(made, "trade_date", MONTHLY), "daily_price_summary", [PERIOD])

    first, second, third = (day(f"2026-01-{n:02}") for n in (5, 6, 7))
    put([("A", first, 1), ("B", first, 2), ("A", second, 3), ("A", third, 4), ("C", None, 1)])
    put([("B", first, 2), ("A", first, 1), ("A", second, 4), ("B", third, 4), ("C", None, 2), ("A", day("2026-02-01"), 1)])
    found = warehouse.changed_groups(spark, "daily_price_summary", "r00000000", "trade_date", ["ticker", "volume"])
    assert tuples(found, "trade_date") == [(None,), (second,), (third,), (day("2026-02-01"),)]
    assert "Aggregate(keys=[trade_date" in plan_of(found) and "ticker" not in plan_of(found).partition("Exchange")[0]
    assert warehouse.changed_groups(spark, "daily_price_summary", "r00000009", "trade_date", ["volume"]) is None
