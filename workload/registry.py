"""Registered queries: every operator and model over the feeds, on whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.payload import first_text, has_key, integral
from tidemark.operators.aggregates import market_daily, pivot_series
from tidemark.operators.dedup import latest_by
from tidemark.operators.rolling import rolling_metrics
from tidemark.operators.scd2 import scd2_history
from tidemark.operators.temporal import asof_join, asof_join_ranged, pit_join, pit_join_bucketed
from tidemark.plans import consumer, gold, silver
from tidemark.plans.marts import build_marts
from tidemark.plans.pipeline import Config, build, company_snapshot
from tidemark.plans.refresh import MACRO, PRICES, read_silver, rebuild_silver, refresh_silver
from tidemark.quality import checks
from tidemark.schemas import (
    COMPANY_CHECK_COLUMNS,
    COMPANY_KEY,
    MACRO_FEED,
    PRICES_FEED,
)
from tidemark.session import configure, shared_dir
from tidemark.sources.bronze import (
    IngestionError,
    append_bronze,
    land,
    list_partitions,
    read_bronze,
    read_rejected,
    with_envelope_error,
)
from tidemark.sources.seeds import read_seed
from tidemark.sources.tables import MONTHLY, PERIOD, Warehouse, with_period
from tidemark.streaming.landing_stream import stream_landing
from tidemark.streaming.silver_stream import stream_silver
from workload import feeds

Query = Callable[[SparkSession, str], DataFrame]

# Digits kept of floating-point results whose last bits depend on the order of addition or on the
# algorithm. All other results are exact sums followed by one division, equal to the last bit.
DIGITS = {"volatility_30d": 6, "market_avg_return": 6, "avg_daily_return_pct": 6}

HISTORY_TICKER = "S7"
FRESHNESS_DAY = date(2026, 1, 31)
SPLIT_DAY = date(2026, 1, 15)


def portable(df: DataFrame) -> DataFrame:
    """Express a result in types that every engine prints alike."""

    def column(field: T.StructField):
        value = F.col(field.name)
        if isinstance(field.dataType, (T.DateType, T.TimestampType)):
            value = value.cast("string")
        elif isinstance(field.dataType, T.DecimalType):
            value = value.cast("double")
        elif field.name in DIGITS:
            value = F.round(value, DIGITS[field.name])
        return value.alias(field.name)

    return df.select(*[column(field) for field in df.schema])


def scratch(spark: SparkSession) -> str:
    """A new folder for tables that a query stores on the way to its result."""
    return f"{shared_dir(spark)}/tidemark/{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """Write a table that several consumers share, and read it back."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


# --- tables ------------------------------------------------------------------------------------


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.stg_stock_prices(feeds.price_responses(spark, sf_dir))


def indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.stg_macro_indicators(feeds.macro_responses(spark, sf_dir))


def snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    snapshots = feeds.company_snapshots(spark, sf_dir)
    return scd2_history(snapshots, COMPANY_KEY, COMPANY_CHECK_COLUMNS, "run_at")


def company(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.dim_company(snapshot(spark, sf_dir))


def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.daily_price_summary(prices(spark, sf_dir))


# The summary has one row per (ticker, trade_date), as deduplication leaves the prices, and versions of
# a company do not overlap: no ticker is counted twice on a day, so the daily marts need no distinct count.


def sectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.sector_performance(summary(spark, sf_dir), company(spark, sf_dir), unique=True)


def market(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.macro_market_correlation(summary(spark, sf_dir), indicators(spark, sf_dir), unique=True)


# --- single operators --------------------------------------------------------------------------


def price_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.parse_prices(feeds.price_responses(spark, sf_dir))


def macro_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.parse_macro(feeds.macro_responses(spark, sf_dir))


def macro_struct_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver macro table from payloads that arrive as nested structs instead of text."""
    payload = "observations array<struct<date:string,value:string>>"
    nested = feeds.macro_responses(spark, sf_dir).withColumn(
        "raw_payload", F.from_json("raw_payload", payload)
    )
    return silver.stg_macro_indicators(nested)


def json_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    props = F.col("props")
    return feeds.table(spark, sf_dir, "events").select(
        "event_id",
        has_key(props, "k").alias("has_k"),
        has_key(props, "j").alias("has_j"),
        first_text(props, "j", "k").alias("k_text"),
        integral(first_text(props, "k")).alias("k"),
    )


def latest_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    quotes = feeds.quotes(spark, sf_dir)
    return latest_by(quotes, silver.PRICE_KEYS, "ingested_at", silver.PRICE_TIE_BREAK)


def rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = latest_quotes(spark, sf_dir).select("ticker", "trade_date", "close_price")
    return rolling_metrics(rows)


def pit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every single quote, duplicates included, with the sector of its day."""
    quotes = feeds.quotes(spark, sf_dir).select("ticker", "trade_date", "close_price")
    versions = company(spark, sf_dir).select("ticker", "sector", "valid_from", "valid_to")
    return pit_join(quotes, versions, key="ticker", date="trade_date").select(
        "ticker", "trade_date", "close_price", "sector"
    )


def asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order with the macro row in force on its day; the earliest orders precede them all."""
    orders = feeds.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.date_sub(F.col("o_orderdate").cast("date"), 90).alias("day")
    )
    return asof_join(orders, pivot_series(indicators(spark, sf_dir)), "day", "observation_date")


def pit_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item with the version of its status that was valid on its day."""
    lines, versions = feeds.shipped_lines(spark, sf_dir), feeds.status_versions(spark, sf_dir)
    return pit_join_bucketed(lines, versions, "status", "day").drop("valid_to")


def asof_intraday(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order with the last event up to its time of day."""
    orders, events = feeds.placed_orders(spark, sf_dir), feeds.events(spark, sf_dir)
    return asof_join_ranged(orders, events, "placed_at", "ts", ["event_id"]).drop("ts")


def scd2_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stored snapshot run per year."""
    table = company_snapshot(Warehouse(scratch(spark)))
    for year in feeds.SNAPSHOT_YEARS:
        table.run(feeds.company_seed(spark, sf_dir, F.lit(year)), datetime(year, 1, 1))
    return silver.dim_company(table.history(spark))


def scd2_late_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same runs in another order: the last year first, then the others backwards by turns."""
    table = company_snapshot(Warehouse(scratch(spark)))
    years = sorted(feeds.SNAPSHOT_YEARS, reverse=True)
    for year in years[::2] + years[1::2]:
        table.run(feeds.company_seed(spark, sf_dir, F.lit(year)), datetime(year, 1, 1))
    return silver.dim_company(table.history(spark))


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [
        with_envelope_error(responses, feed).select(
            F.lit(feed.table).alias("feed"), F.col(feed.key).alias("name"), "error"
        )
        for responses, feed in (
            (feeds.mixed_price_responses(spark, sf_dir), PRICES_FEED),
            (feeds.mixed_macro_responses(spark, sf_dir), MACRO_FEED),
        )
    ]
    return reduce(DataFrame.unionByName, parts)


def bronze_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land a mix of usable and failed responses, then count what went where."""
    bronze, moment = scratch(spark), datetime.fromisoformat("2026-01-05T22:15:00+00:00")
    land(feeds.mixed_price_responses(spark, sf_dir), bronze, PRICES_FEED, moment)
    return landed_counts(spark, bronze)


def bronze_landing_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same batch three times, the first time only a part of it: every response is there once."""
    bronze, moment = scratch(spark), datetime.fromisoformat("2026-01-05T22:15:00+00:00")
    responses = stored(feeds.mixed_price_responses(spark, sf_dir).distinct())
    land(responses.filter("hash(ticker) % 3 = 0"), bronze, PRICES_FEED, moment, once=True)
    for _ in range(2):
        land(responses, bronze, PRICES_FEED, moment, once=True)
    return landed_counts(spark, bronze)


def landing_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same responses as a stream of files, in several micro-batches; a second run finds nothing."""
    bronze, moment, staged, checkpoint = scratch(spark), datetime.fromisoformat("2026-01-05T22:15:00+00:00"), scratch(spark), scratch(spark)
    responses = feeds.mixed_price_responses(spark, sf_dir).distinct()
    responses.repartition(6, "ticker").write.parquet(staged)
    for _ in range(2):
        arriving = spark.readStream.schema(responses.schema).option("maxFilesPerTrigger", 2).parquet(staged)
        stream_landing(arriving, bronze, PRICES_FEED, checkpoint, moment)
    return landed_counts(spark, bronze)


def landed_counts(spark: SparkSession, bronze: str) -> DataFrame:
    """What went where."""
    good = read_bronze(spark, bronze, PRICES_FEED).select(
        F.lit("landed").alias("outcome"), "ticker", "ingested_at", "api_function", "ingest_date"
    )
    bad = read_rejected(spark, bronze, PRICES_FEED).select(
        F.lit("rejected").alias("outcome"),
        "ticker",
        "ingested_at",
        F.lit(None).cast("string").alias("api_function"),
        F.lit(None).cast("date").alias("ingest_date"),
    )
    return (
        good.unionByName(bad)
        .groupBy("outcome", "ingested_at", "api_function", "ingest_date")
        .agg(F.count(F.lit(1)).alias("responses"), F.count_distinct("ticker").alias("tickers"))
    )


def macro_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land macro responses that hold failures: all are stored or set aside, and the run fails."""
    bronze, moment = scratch(spark), datetime.fromisoformat("2026-01-05T22:15:00+00:00")
    try:
        land(feeds.mixed_macro_responses(spark, sf_dir), bronze, MACRO_FEED, moment)
        failed = False
    except IngestionError:
        failed = True
    good = read_bronze(spark, bronze, MACRO_FEED).select(
        F.lit("landed").alias("outcome"), "series_id", "source", F.lit(None).cast("string").alias("error")
    )
    bad = read_rejected(spark, bronze, MACRO_FEED).select(
        F.lit("rejected").alias("outcome"),
        "series_id",
        F.lit(None).cast("string").alias("source"),
        F.substring_index("error", ": ", -1).alias("error"),
    )
    return (
        good.unionByName(bad)
        .groupBy("outcome", "source", "error")
        .agg(F.count(F.lit(1)).alias("responses"), F.count_distinct("series_id").alias("series"))
        .withColumn("run_failed", F.lit(failed))
    )


def landed_prices(spark: SparkSession, sf_dir: str) -> str:
    bronze = scratch(spark)
    append_bronze(feeds.price_responses(spark, sf_dir, by_day=True), bronze, PRICES_FEED, by_day=True)
    return bronze


def bronze_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return list_partitions(spark, f"{landed_prices(spark, sf_dir)}/{PRICES_FEED.table}")


def bronze_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses per ingestion day, read back from partition folders with column pruning."""
    rows = read_bronze(spark, landed_prices(spark, sf_dir), PRICES_FEED)
    return rows.groupBy("ingest_date", "source", "api_function").agg(
        F.count(F.lit(1)).alias("responses"), F.count_distinct("ticker").alias("tickers")
    )


def seed_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark)
    seed = feeds.company_seed(spark, sf_dir, F.lit(feeds.SNAPSHOT_YEARS.start))
    seed.write.option("header", True).csv(path)
    return read_seed(spark, path)


def incremental_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two refreshes, older days first, must equal the full rebuild."""
    bronze, warehouse = landed_prices(spark, sf_dir), Warehouse(scratch(spark))
    refresh_silver(spark, bronze, PRICES, warehouse, until=SPLIT_DAY)
    refresh_silver(spark, bronze, PRICES, warehouse, since=date(2026, 1, 16))
    return read_silver(spark, PRICES, warehouse)


def struct_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver from bronze whose days hold text or structs of three kinds, in two refreshes."""
    bronze, warehouse = scratch(spark), Warehouse(scratch(spark))
    feeds.mixed_macro_bronze(spark, sf_dir, bronze)
    refresh_silver(spark, bronze, MACRO, warehouse, since=date(2026, 1, 16))
    refresh_silver(spark, bronze, MACRO, warehouse, until=SPLIT_DAY)
    return read_silver(spark, MACRO, warehouse)


def struct_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same folder through the stream."""
    bronze, warehouse = scratch(spark), Warehouse(scratch(spark))
    feeds.mixed_macro_bronze(spark, sf_dir, bronze)
    stream_silver(spark, bronze, MACRO, warehouse, scratch(spark), max_files_per_trigger=15).awaitTermination()
    return read_silver(spark, MACRO, warehouse)


def stream_macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze, warehouse = scratch(spark), Warehouse(scratch(spark))
    append_bronze(feeds.macro_responses(spark, sf_dir, by_day=True), bronze, MACRO_FEED, by_day=True)
    stream_silver(spark, bronze, MACRO, warehouse, scratch(spark)).awaitTermination()
    return read_silver(spark, MACRO, warehouse)


def stream_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The macro stream in several micro-batches, which must not show in the result."""
    bronze, warehouse = scratch(spark), Warehouse(scratch(spark))
    append_bronze(feeds.macro_responses(spark, sf_dir, by_day=True), bronze, MACRO_FEED, by_day=True)
    stream = stream_silver(spark, bronze, MACRO, warehouse, scratch(spark), max_files_per_trigger=10)
    stream.awaitTermination()
    return read_silver(spark, MACRO, warehouse)


def stream_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze, warehouse = landed_prices(spark, sf_dir), Warehouse(scratch(spark))
    stream_silver(spark, bronze, PRICES, warehouse, scratch(spark)).awaitTermination()
    return read_silver(spark, PRICES, warehouse)


# --- quality -----------------------------------------------------------------------------------


def all_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every declared not-null and uniqueness test over the five tables."""
    stocks, macro = stored(prices(spark, sf_dir)), stored(indicators(spark, sf_dir))
    daily = stored(gold.daily_price_summary(stocks))
    tables = {
        "stg_stock_prices": stocks,
        "stg_macro_indicators": macro,
        "daily_price_summary": daily,
        "sector_performance": gold.sector_performance(daily, company(spark, sf_dir), unique=True, by_ticker=False),
        "macro_market_correlation": gold.macro_market_correlation(daily, macro, unique=True),
    }
    tests = [test for name, df in tables.items() for test in checks.column_tests(df, name)]
    return reduce(DataFrame.unionByName, tests)


def raw_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same tests on quotes before deduplication, where they do find failures."""
    changes = rolling(spark, sf_dir)
    nulls = checks.not_null(changes, "rolling", ["close_price", "volatility_30d", "prev_close"])
    repeated = checks.unique_combination(feeds.quotes(spark, sf_dir), "quotes", silver.PRICE_KEYS)
    return nulls.unionByName(repeated)


def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.freshness(feeds.price_responses(spark, sf_dir), F.lit(FRESHNESS_DAY), 3)


def volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.latest_ticker_count(stored(prices(spark, sf_dir)))


def negative(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Negative prices among quotes marked down by 20,000, so that there are some."""
    lower = {c: (F.col(c) - 20000).alias(c) for c in checks.PRICE_COLUMNS}
    return checks.negative_prices(feeds.quotes(spark, sf_dir).select(*lower.values()))


def check_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All table checks over the feed; the number of tickers is far above the default range."""
    stocks = stored(prices(spark, sf_dir))
    bronze = feeds.price_responses(spark, sf_dir)
    return checks.check_report(bronze, stocks, F.lit(FRESHNESS_DAY))


def stored_prices(spark: SparkSession, sf_dir: str) -> Warehouse:
    """A warehouse with the price table and the summary over it."""
    warehouse = Warehouse(scratch(spark))
    rebuild_silver(spark, landed_prices(spark, sf_dir), PRICES, warehouse)
    daily = gold.daily_price_summary(read_silver(spark, PRICES, warehouse))
    warehouse.replace(with_period(daily, "trade_date", MONTHLY), "daily_price_summary", [PERIOD])
    return warehouse


def recent_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest rows, from the newest period folders."""
    return consumer.top_recent_prices(stored_prices(spark, sf_dir).newest(spark, "daily_price_summary", 10))


def volume_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tickers on the latest day, from the newest period folder."""
    return checks.latest_ticker_count(stored_prices(spark, sf_dir).newest(spark, PRICES.name, 1))


def variant_price_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.parse_variant_prices(feeds.price_responses(spark, sf_dir))


def stored_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per monthly folder of the rebuilt price table."""
    warehouse = Warehouse(scratch(spark))
    rebuild_silver(spark, landed_prices(spark, sf_dir), PRICES, warehouse)
    stocks = warehouse.read(spark, PRICES.name)
    return stocks.groupBy("period").agg(F.count(F.lit(1)).alias("row_count"))


def mart_values(tables: dict[str, DataFrame]) -> DataFrame:
    """The rows of the three marts side by side."""
    days = tables["daily_price_summary"].select(
        F.lit("daily_price_summary").alias("table"), F.col("ticker").alias("name"), "trade_date",
        F.col("daily_return_pct").alias("return_pct"), "volume", F.lit(1).cast("long").alias("n"),
    )
    sector = tables["sector_performance"].select(
        F.lit("sector_performance"), "sector", "trade_date",
        F.round("avg_daily_return_pct", 6), "total_volume", "num_companies",
    )
    market_days = tables["macro_market_correlation"].select(
        F.lit("macro_market_correlation"), F.col("macro_observation_date").cast("string"),
        "trade_date", F.round("market_avg_return", 6), "market_total_volume", "num_tickers",
    )
    return reduce(DataFrame.union, [days, sector, market_days])


def incremental_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marts built over the later pulls, then refreshed by the earlier ones, must equal a full build."""
    bronze, warehouse = scratch(spark), Warehouse(scratch(spark))
    append_bronze(feeds.price_responses(spark, sf_dir, by_day=True), bronze, PRICES_FEED, by_day=True)
    append_bronze(feeds.macro_responses(spark, sf_dir, by_day=True), bronze, MACRO_FEED, by_day=True)
    snapshot = company_snapshot(warehouse)
    snapshot.run(feeds.company_seed(spark, sf_dir, F.lit(feeds.SNAPSHOT_YEARS.start)), datetime(1998, 1, 1))
    company = silver.dim_company(snapshot.history(spark))
    found = {}
    for since, until in ((date(2026, 1, 8), None), (None, date(2026, 1, 7))):
        for table in (PRICES, MACRO):
            refresh_silver(spark, bronze, table, warehouse, since, until)
        found = build_marts(spark, warehouse, snapshot, company, incremental=True)
    return mart_values(found)


def medallion_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole build, stored layer by layer: values of the three marts, rows of every table."""
    bronze = scratch(spark)
    append_bronze(feeds.price_responses(spark, sf_dir, by_day=True), bronze, PRICES_FEED, by_day=True)
    append_bronze(feeds.macro_responses(spark, sf_dir, by_day=True), bronze, MACRO_FEED, by_day=True)
    seed = feeds.company_seed(spark, sf_dir, F.lit(feeds.SNAPSHOT_YEARS.start))
    config = Config(bronze=bronze, warehouse=scratch(spark))
    tables = build(spark, config, run_at=datetime(1998, 1, 1), seed=seed)
    counts = [
        df.agg(
            F.lit("rows"), F.lit(name), F.lit(None).cast("date"), F.lit(None).cast("double"),
            F.lit(None).cast("long"), F.count(F.lit(1)),
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.union, [mart_values(tables), *counts])


QUERIES: dict[str, Query] = {
    "stg_stock_prices": prices,
    "stg_macro_indicators": indicators,
    "dim_company": company,
    "daily_price_summary": summary,
    "sector_performance": sectors,
    "macro_market_correlation": market,
    "price_bars": price_bars,
    "macro_observations": macro_observations,
    "macro_struct_payload": macro_struct_payload,
    "json_extract": json_extract,
    "latest_by_key": latest_quotes,
    "rolling_metrics": rolling,
    "pit_join": pit,
    "asof_join": asof,
    "macro_pivot": lambda s, d: pivot_series(indicators(s, d)),
    "market_daily": lambda s, d: market_daily(summary(s, d), unique=True),
    "scd2_snapshot": snapshot,
    "scd2_merge": scd2_runs,
    "scd2_late_runs": scd2_late_runs,
    "top_recent_prices": lambda s, d: consumer.top_recent_prices(summary(s, d)),
    "ticker_history": lambda s, d: consumer.ticker_history(summary(s, d), HISTORY_TICKER),
    "sector_ranking": lambda s, d: consumer.sector_ranking(sectors(s, d)),
    "sector_by_day": lambda s, d: consumer.sector_by_day(sectors(s, d)),
    "macro_context": lambda s, d: consumer.macro_context(market(s, d)),
    "market_by_day": lambda s, d: consumer.market_by_day(market(s, d)),
    "company_history": lambda s, d: consumer.company_history(company(s, d), HISTORY_TICKER),
    "bronze_envelope": envelopes,
    "bronze_landing": bronze_landing,
    "macro_landing": macro_landing,
    "bronze_partitions": bronze_partitions,
    "bronze_scan": bronze_scan,
    "seed_load": seed_load,
    "dq_column_tests": all_tests,
    "dq_raw_tests": raw_tests,
    "dq_freshness": freshness,
    "dq_volume": volume,
    "dq_negative": negative,
    "incremental_silver": incremental_silver,
    "stream_silver_prices": stream_prices,
    "stream_silver_macro": stream_macro,
    "stream_micro_batches": stream_batches,
    "dq_report": check_report,
    "stored_periods": stored_periods,
    "medallion_build": medallion_build,
    "incremental_gold": incremental_gold,
    "bronze_landing_retry": bronze_landing_retry,
    "stream_landing": landing_stream,
    "recent_prices_stored": recent_stored,
    "dq_volume_stored": volume_stored,
    "variant_bars": variant_price_bars,
    "asof_intraday": asof_intraday,
    "pit_join_versions": pit_versions,
    "struct_bronze_silver": struct_bronze,
    "struct_bronze_stream": struct_stream,
}


def registered() -> dict[str, Query]:
    """Queries under their public names, with portable result types."""

    def wrap(query: Query) -> Query:
        return lambda spark, sf_dir: portable(query(configure(spark), sf_dir))

    return {name: wrap(query) for name, query in QUERIES.items()}
