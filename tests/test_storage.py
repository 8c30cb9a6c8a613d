"""Safe writes: overwrite modes, versions, markers, struct payloads, names and session settings."""

from __future__ import annotations

import json
import random
from datetime import date, datetime, timedelta

import pytest
from helpers import at, bar, day, plan_of, tuples
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.operators.temporal import asof_join, asof_join_ranged, pit_join, pit_join_bucketed
from tidemark.plans import consumer, pipeline
from tidemark.plans.gold import macro_market_correlation, sector_performance
from tidemark.plans.refresh import PRICES, read_silver, rebuild_silver, refresh_silver
from tidemark.quality.checks import QualityError
from tidemark.schemas import PRICES_FEED
from tidemark.sources import bronze as bronze_module
from tidemark.sources.samples import write_samples
from tidemark.streaming.silver_stream import stream_silver
from tidemark.sources.tables import KEPT_VERSIONS, MONTHLY, PERIOD, Warehouse, register_databases, with_period

SEED = "ticker string, company_name string, sector string, exchange string, effective_date date"
COMPANIES = [(t, t, "Technology", "NASDAQ", date(2026, 1, 1)) for t in ("AAPL", "MSFT", "GOOGL")]


@pytest.fixture(scope="module")
def samples(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("samples"))
    write_samples(spark, root, date(2026, 8, 30))
    return root


def built(spark, samples, root, seed=COMPANIES):
    config = pipeline.Config(bronze=samples, warehouse=str(root))
    return pipeline.build(spark, config, run_at=at("2026-08-01"), seed=spark.createDataFrame(seed, SEED))


def contents(tables):
    return {name: sorted(map(str, df.collect())) for name, df in tables.items()}


def test_overwrite_mode_of_the_session_does_not_matter(spark, samples, tmp_path):
    static = contents(built(spark, samples, tmp_path / "static"))
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        dynamic = contents(built(spark, samples, tmp_path / "dynamic"))
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert static == dynamic and all(static.values())


def test_time_zone_of_the_session_does_not_matter(spark, samples, tmp_path):
    utc = contents(built(spark, samples, tmp_path / "utc"))
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    elsewhere = contents(built(spark, samples, tmp_path / "new_york"))
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC" and utc == elsewhere


def test_a_month_that_is_gone_goes(spark, tmp_path):
    warehouse = Warehouse(str(tmp_path))
    for month in ("2026-01", "2026-02"):
        rows = spark.createDataFrame([(1, month)], f"x int, {PERIOD} string")
        stored = warehouse.replace(rows, "daily_price_summary", [PERIOD])
    assert [tuple(r) for r in stored.collect()] == [(1, "2026-02")]


def test_a_failed_refresh_leaves_the_old_rows(spark, tmp_path):
    warehouse = Warehouse(str(tmp_path))
    warehouse.replace(spark.range(3), "sector_performance")
    with pytest.raises(PySparkException):
        warehouse.replace(spark.range(9).select(F.raise_error(F.lit("x")).alias("id")), "sector_performance")
    assert warehouse.read(spark, "sector_performance").count() == 3
    assert warehouse.replace(spark.range(5), "sector_performance").count() == 5


def test_old_versions_and_their_folders_go(spark, tmp_path):
    warehouse = Warehouse(str(tmp_path))
    name, path = "daily_price_summary", tmp_path / "gold" / "daily_price_summary"
    warehouse.replace(spark.createDataFrame([(0, "a"), (0, "b")], f"x int, {PERIOD} string"), name, [PERIOD])
    for x in range(KEPT_VERSIONS + 2):
        warehouse.replace_periods(spark.createDataFrame([(x, "b")], f"x int, {PERIOD} string"), name, ["b"])
    assert len(warehouse.versions(spark, name)) == KEPT_VERSIONS
    assert sorted(map(tuple, warehouse.read(spark, name).collect())) == [(0, "a"), (KEPT_VERSIONS + 1, "b")]
    assert len(list(path.glob("v=*/period=a"))) == 1 and len(list(path.glob("v=*/period=b"))) == KEPT_VERSIONS


def test_unchanged_snapshot_runs_store_nothing(spark, tmp_path):
    table = pipeline.company_snapshot(Warehouse(str(tmp_path)))
    seed = spark.createDataFrame(COMPANIES, SEED)
    sizes = []
    for month in range(1, 6):
        table.run(seed, datetime(2026, month, 1))
        sizes.append(spark.read.parquet(table.path).count())
    assert sizes == [3] * 5 and table.history(spark).count() == 3


def test_repeated_or_missing_seed_keys_stop_the_build(spark, samples, tmp_path):
    for extra in (COMPANIES[0], (None, "x", "y", "z", None)):
        with pytest.raises(QualityError, match="company_metadata"):
            built(spark, samples, tmp_path, [*COMPANIES, extra])


def test_consumers_find_every_table_by_name(spark, samples, tmp_path):
    tables = built(spark, samples, tmp_path)
    pipeline.register_tables(spark, Warehouse(str(tmp_path)))
    query = "SELECT ticker, dbt_valid_from FROM main.dim_company_snapshot WHERE ticker = 'AAPL'"
    assert spark.sql(query).count() == 1
    assert spark.table("main_silver.dim_company").count() == 3
    assert spark.table("main_gold.sector_performance").count() == tables["sector_performance"].count()


def test_an_empty_table_has_a_name_too(spark, tmp_path):
    warehouse = Warehouse(str(tmp_path))
    empty = spark.createDataFrame([], f"trade_date date, sector string, {PERIOD} string")
    assert warehouse.replace(empty, "sector_performance", [PERIOD]).isEmpty()
    register_databases(spark, warehouse, ["sector_performance"])
    assert spark.table("main_gold.sector_performance").count() == 0
    rows = spark.createDataFrame([(day("2026-01-05"), "Energy", "2026")], empty.schema)
    warehouse.replace_periods(rows, "sector_performance", ["2026"])
    assert spark.table("main_gold.sector_performance").columns == ["trade_date", "sector"]
    assert spark.table("main_gold.sector_performance").count() == 1


def struct_day(spark, root, ingested, days, close):
    """One day's responses with the bars of their days as fields of a struct."""
    bars = F.struct(*[
        F.struct(*[F.lit(v).alias(k) for k, v in bar(close + i).items()]).alias(d) for i, d in enumerate(days)
    ])
    payload = F.struct(F.struct(F.lit("x").alias("2. Symbol")).alias("Meta Data"), bars.alias("Time Series (Daily)"))
    rows = spark.createDataFrame([("AAPL",), ("MSFT",)], "ticker string").select(
        "ticker", payload.alias("raw_payload"), F.lit(f"{ingested}T01:00:00").alias("ingested_at"),
        F.lit("s").alias("source"), F.lit("f").alias("api_function"),
    )
    rows.write.parquet(f"{root}/{PRICES_FEED.table}/ingest_date={ingested}")


def test_struct_bronze_goes_through_the_product(spark, tmp_path, monkeypatch):
    root, warehouse = f"{tmp_path}/bronze", Warehouse(f"{tmp_path}/w")
    struct_day(spark, root, "2026-01-01", ["2025-12-30", "2025-12-31"], 10)
    struct_day(spark, root, "2026-01-02", ["2025-12-31", "2026-01-01"], 20)
    struct_day(spark, root, "2026-01-03", ["2026-01-02"], 30)
    rebuild_silver(spark, root, PRICES, warehouse)
    expected = {("2025-12-30", 10), ("2025-12-31", 20), ("2026-01-01", 21), ("2026-01-02", 30)}

    def found():
        rows = read_silver(spark, PRICES, warehouse).filter("ticker = 'AAPL'").collect()
        return {(str(r.trade_date), int(r.close_price)) for r in rows}

    assert found() == expected
    # new files cost their own conversion only, also those of a day that is known
    looked_at, by_schema = [], bronze_module.by_schema

    def counted(session, table, files):
        looked_at.extend(files)
        return by_schema(session, table, files)

    monkeypatch.setattr(bronze_module, "by_schema", counted)
    struct_day(spark, root, "2026-01-04", ["2026-01-02", "2026-01-03"], 40)
    refresh_silver(spark, root, PRICES, warehouse, since=date(2026, 1, 4))
    assert found() == expected - {("2026-01-02", 30)} | {("2026-01-02", 40), ("2026-01-03", 41)}
    assert {file.split("/")[0] for file in looked_at} == {"ingest_date=2026-01-04"}
    looked_at.clear()
    text_day(spark, root, "2026-01-04", {"2026-01-05": bar(50)})
    refresh_silver(spark, root, PRICES, warehouse, since=date(2026, 1, 4))
    assert found() == expected - {("2026-01-02", 30)} | {("2026-01-02", 40), ("2026-01-03", 41), ("2026-01-05", 50)}
    assert len(looked_at) == 1
    # the stream reads the same files, whatever they hold, and ends with the same rows
    streamed = Warehouse(f"{tmp_path}/s")
    for _ in range(2):
        stream_silver(spark, root, PRICES, streamed, f"{tmp_path}/checkpoint", max_files_per_trigger=2).awaitTermination()
    assert tuples(read_silver(spark, PRICES, streamed), "*") == tuples(read_silver(spark, PRICES, warehouse), "*")


def text_day(spark, root, ingested, series):
    rows = [("AAPL", json.dumps({"Time Series (Daily)": series}), f"{ingested}T02:00:00", "s", "f")]
    names = "ticker string, raw_payload string, ingested_at string, source string, api_function string"
    spark.createDataFrame(rows, names).coalesce(1).write.mode("append").parquet(f"{root}/{PRICES_FEED.table}/ingest_date={ingested}")


def test_schemas_are_read_once_per_kind(spark, tmp_path):
    root, table = f"{tmp_path}/bronze", f"{tmp_path}/bronze/{PRICES_FEED.table}"
    for n in range(1, 5):
        struct_day(spark, root, f"2026-01-0{n}", ["2025-12-30"] if n % 2 else ["2025-12-31"], n)
    text_day(spark, root, "2026-01-05", {"2026-01-05": bar(50)})
    text_day(spark, root, "2026-01-01", {"2026-01-05": bar(60)})  # beside structs
    files = bronze_module.bronze_files(spark, root, PRICES_FEED)
    groups = bronze_module.by_schema(spark, table, files)
    assert len(groups) == 3 and sum(len(own) for _, own in groups) == len(files)
    rows = bronze_module.read_files(spark, table, PRICES_FEED, groups)
    assert rows.count() == 10 and plan_of(rows).count("FileScan") == 3


def test_marts_over_stored_tables_shuffle_once(spark, samples, tmp_path):
    tables = built(spark, samples, tmp_path)
    market = plan_of(macro_market_correlation(tables["daily_price_summary"], tables["stg_macro_indicators"], unique=True))
    assert "hashpartitioning(trade_date" in market and "ticker" not in market.split("hashpartitioning(")[1].split(")")[0]
    sector = plan_of(sector_performance(tables["daily_price_summary"], tables["dim_company"], unique=True, by_ticker=False))
    assert sector.count("hashpartitioning(trade_date") == 1


def test_asof_join_wants_one_row_per_date(spark):
    left = spark.createDataFrame([(day("2026-01-05"),)], "d date")
    right = spark.createDataFrame([(day("2026-01-01"), 1), (day("2026-01-01"), 2)], "r date, v int")
    with pytest.raises(ValueError, match="one row per date"):
        asof_join(left, right, "d", "r")


def test_asof_join_above_the_broadcast_threshold(spark):
    left = spark.range(3000).select(F.date_add(F.lit("2019-06-01").cast("date"), F.col("id").cast("int")).alias("d"))
    right = spark.range(1000).select(
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") * 2).cast("int")).alias("r"), F.col("id").alias("v")
    )
    expected = sorted(map(str, asof_join(left, right, "d", "r").collect()))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = asof_join(left, right, "d", "r")
        assert "SortMergeJoin" in plan_of(joined)
        assert sorted(map(str, joined.collect())) == expected and len(expected) == 3000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_ranged_asof_join_equals_a_search(spark):
    """Ties on both sides, hot times, times before all right rows, missing times, empty sides."""
    rng = random.Random(5)
    base = datetime(2026, 1, 1)
    right = [(None if rng.random() < 0.1 else base + timedelta(seconds=rng.randint(100, 900)), i) for i in range(300)]
    left = [(None if rng.random() < 0.1 else base + timedelta(seconds=rng.choice([500, rng.randint(0, 1000)])), i) for i in range(900)]
    of = {r: max(i for t, i in right if t == r) for r, _ in right if r is not None}
    expected = sorted((i, *((best := max((r for r in of if t is not None and r <= t), default=None)), of.get(best))) for t, i in left)
    lefts = spark.createDataFrame(left, "t timestamp, id int").repartition(5)
    rights = spark.createDataFrame(right, "r timestamp, v int").repartition(5)
    joined = asof_join_ranged(lefts, rights, "t", "r", ["v"])
    assert joined.columns == ["t", "id", "r", "v"]
    assert sorted((r.id, r.r, r.v) for r in joined.collect()) == expected
    assert "SinglePartition" not in plan_of(joined)
    assert asof_join_ranged(lefts, rights.limit(0), "t", "r").filter("v IS NULL AND r IS NULL").count() == 900
    assert asof_join_ranged(lefts.limit(0), rights, "t", "r").isEmpty()


def test_bucketed_join_equals_the_plain_one_and_meets_few_versions(spark):
    days = spark.range(4000).select(F.date_add(F.lit("2015-01-01").cast("date"), (F.col("id") % 1400).cast("int")).alias("d"), F.lit("k").alias("key"), "id")
    start = F.date_add(F.lit("2014-06-01").cast("date"), F.col("id").cast("int"))
    # a day each, one of them a year, and one that is open
    ends = F.when(F.col("id") == 40, F.date_add(start, 365)).when(F.col("id") == 999, F.lit("9999-12-31").cast("date")).otherwise(F.date_add(start, 1))
    versions = spark.range(1000).select(F.lit("k").alias("key"), start.alias("valid_from"), ends.alias("valid_to"), F.col("id").alias("version"))
    joined = pit_join_bucketed(days, versions, "key", "d", days=16)
    assert tuples(joined, "*") == tuples(pit_join(days, versions, "key", "d").select(*joined.columns), "*")
    spans = versions.filter("valid_to > DATE'2015-01-01'").groupBy(F.floor(F.unix_date("valid_from") / 16)).count()
    assert spans.agg(F.max("count")).first()[0] <= 16


def test_newest_rows_open_few_folders(spark, tmp_path):
    """The limit is filled from the newest folders; undated rows come last."""
    warehouse = Warehouse(str(tmp_path))
    days = spark.range(400).select(
        F.date_add(F.lit("2025-01-01").cast("date"), F.col("id").cast("int")).alias("trade_date"), F.lit("A").alias("ticker"),
        *[F.lit(1.0).alias(n) for n in ("close_price", "ma_7d", "daily_return_pct")],
    )
    rows = with_period(days.unionByName(days.limit(1).withColumn("trade_date", F.lit(None).cast("date"))), "trade_date", MONTHLY)
    warehouse.replace(rows, "daily_price_summary", [PERIOD])
    whole = tuples(consumer.top_recent_prices(warehouse.read(spark, "daily_price_summary")), "*")
    newest = warehouse.newest(spark, "daily_price_summary", 10)
    assert len({file.split("period=")[1].split("/")[0] for file in newest.inputFiles()}) <= 2
    assert tuples(consumer.top_recent_prices(newest), "*") == whole
    everything = warehouse.newest(spark, "daily_price_summary", 1000)
    assert everything.count() == 401
