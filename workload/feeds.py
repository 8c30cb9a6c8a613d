"""Market-data feeds derived from the generic test tables.

The test tables hold no prices, so each raw feed is built from a table of similar shape:

* price responses from ``lineitem``: a supplier is a ticker, a line item is one daily bar;
* macro responses from ``orders``: an order priority is a series, an order one observation;
* company snapshots from ``supplier``: one snapshot per year, some sectors moving over time.

Every feed is a narrow projection of its table, one response per row, so building it needs no
shuffle and no group is ever collected. A line item or order is "pulled" on one of 28 days,
which makes the same (ticker, day) arrive several times, as overlapping API pulls would.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.schemas import (
    MACRO_FEED,
    OBSERVATIONS_KEY,
    PRICE,
    PRICE_BAR_FIELDS,
    PRICE_SERIES_KEY,
    PRICES_FEED,
)

FIRST_PULL = "2026-01-01"
PULL_DAYS = 28
SNAPSHOT_YEARS = range(1995, 2002)
MACRO_SERIES = {
    "1-URGENT": "FEDFUNDS",
    "2-HIGH": "CPIAUCSL",
    "3-MEDIUM": "UNRATE",
    "4-NOT SPECIFIED": "UNRATE",
    "5-LOW": "GDP",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pull_day(order_key: str) -> Column:
    return F.date_add(F.lit(FIRST_PULL).cast("date"), F.pmod(F.col(order_key), PULL_DAYS).cast("int"))


def _pulled_at(order_key: str, hour: Column) -> Column:
    """ISO text: the pull day follows from the order key, the hour is given."""
    day = _pull_day(order_key)
    return F.concat(day.cast("string"), F.lit("T"), F.lpad(hour.cast("string"), 2, "0"), F.lit(":00:00"))


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily bars behind the price responses, as plain columns."""
    return _dated_quotes(spark, sf_dir, by_day=False).drop("ingest_date")


def _dated_quotes(spark: SparkSession, sf_dir: str, by_day: bool) -> DataFrame:
    """Quotes with the day they are pulled on; ``by_day``: sorted by it, in each partition, while they are narrow."""
    close = F.col("l_extendedprice").cast(PRICE)
    spread = F.col("l_quantity").cast(PRICE)
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate",
        _pull_day("l_orderkey").alias("ingest_date"),
    )
    lines = lines.sortWithinPartitions("ingest_date") if by_day else lines
    return lines.select(
        F.concat(F.lit("S"), F.col("l_suppkey")).alias("ticker"),
        F.col("l_shipdate").cast("date").alias("trade_date"),
        (close - spread).cast(PRICE).alias("open_price"),
        (close + spread).cast(PRICE).alias("high_price"),
        (close - 2 * spread).cast(PRICE).alias("low_price"),
        close.alias("close_price"),
        F.col("l_quantity").cast("bigint").alias("volume"),
        _pulled_at("l_orderkey", F.col("l_linenumber")).alias("ingested_at"),
        "ingest_date",
    )


def price_responses(spark: SparkSession, sf_dir: str, by_day: bool = False) -> DataFrame:
    """``daily_prices_raw``: one JSON response per line item; ``by_day`` as ``append_bronze`` takes them."""
    bar = F.struct(
        *[F.col(name).cast("string").alias(field) for name, field in PRICE_BAR_FIELDS.items()]
    )
    payload = F.struct(
        F.struct(
            F.lit("Daily Prices").alias("1. Information"), F.col("ticker").alias("2. Symbol")
        ).alias("Meta Data"),
        F.create_map(F.col("trade_date").cast("string"), bar).alias(PRICE_SERIES_KEY),
    )
    return _dated_quotes(spark, sf_dir, by_day).select(
        "ticker",
        F.to_json(payload).alias("raw_payload"),
        "ingested_at",
        F.lit(PRICES_FEED.source).alias("source"),
        F.lit(PRICES_FEED.api_function).alias("api_function"),
        "ingest_date",
    )


def macro_responses(spark: SparkSession, sf_dir: str, by_day: bool = False) -> DataFrame:
    """``fred_series_raw``: each response reports its month and restates the month before; ``by_day`` as for prices.

    GDP is quarterly and dated in the middle of the quarter's first month, so on those dates it is
    the only series. Orders without a priority report a missing value, every seventh of them one that is no number.
    """
    orders = (
        table(spark, sf_dir, "orders")
        .select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
        .withColumn("ingest_date", _pull_day("o_orderkey"))
    )
    orders = orders.sortWithinPartitions("ingest_date") if by_day else orders
    orders = orders.withColumn("ordered", F.col("o_orderdate").cast("date"))
    series = F.create_map(*[F.lit(x) for pair in MACRO_SERIES.items() for x in pair])
    start = F.trunc("ordered", "month")
    quarterly = F.col("o_orderpriority") == "5-LOW"
    dated = F.when(quarterly, F.date_add(F.trunc("ordered", "quarter"), 14)).otherwise(start)
    before = F.when(quarterly, F.add_months(dated, -3)).otherwise(F.add_months(dated, -1))
    price = F.col("o_totalprice").cast(PRICE)
    unspecified = F.col("o_orderpriority") == "4-NOT SPECIFIED"
    value = (
        F.when(unspecified & (F.col("o_orderkey") % 7 == 0), "n/a")
        .when(unspecified, ".")
        .otherwise(price.cast("string"))
    )
    observation = [
        F.struct(dated.cast("string").alias("date"), value.alias("value")),
        F.struct(before.cast("string").alias("date"), (price + 1).cast("string").alias("value")),
    ]
    payload = F.struct(F.array(*observation).alias(OBSERVATIONS_KEY))
    ingested_at = _pulled_at("o_orderkey", F.pmod(F.col("o_custkey"), F.lit(24)))
    return orders.select(
        series[F.col("o_orderpriority")].alias("series_id"),
        F.to_json(payload).alias("raw_payload"),
        ingested_at.alias("ingested_at"),
        F.lit(MACRO_FEED.source).alias("source"),
        "ingest_date",
    )


def company_seed(spark: SparkSession, sf_dir: str, year: Column) -> DataFrame:
    """Company metadata as recorded in ``year``; two thirds of the companies move every second year."""
    step = F.floor((F.col("year") - SNAPSHOT_YEARS.start) / 2) * (F.col("s_suppkey") % 3)
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", F.col("r_name").alias("sector"))
    supplier = table(spark, sf_dir, "supplier").join(
        nation, F.col("s_nationkey") == F.col("n_nationkey")
    )
    located = supplier.withColumn("year", year).withColumn(
        "_region", F.pmod(F.col("n_regionkey") + step, F.lit(5))
    )
    return located.join(region, F.col("_region") == F.col("r_regionkey")).select(
        F.concat(F.lit("S"), F.col("s_suppkey")).alias("ticker"),
        F.col("s_name").alias("company_name"),
        "sector",
        F.when(F.col("s_acctbal") < 0, "NYSE").otherwise("NASDAQ").alias("exchange"),
        F.make_date(F.col("year"), F.lit(1), F.lit(1)).alias("effective_date"),
    )


def company_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company metadata of every snapshot year, with the time each snapshot ran."""
    years = F.explode(F.array(*[F.lit(year) for year in SNAPSHOT_YEARS]))
    return company_seed(spark, sf_dir, years).withColumn(
        "run_at", F.col("effective_date").cast("timestamp")
    )


def mixed_price_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price responses of which four in five are error envelopes of different kinds."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    reason, kind = F.col("o_orderpriority"), F.col("o_orderkey") % 5
    payload = (
        F.when(kind == 0, F.to_json(F.struct(F.create_map().alias(PRICE_SERIES_KEY))))
        .when(kind == 1, F.to_json(F.struct(reason.alias("Note"), F.lit("x").alias("Information"))))
        .when(
            kind == 2,
            F.to_json(F.struct(F.lit("").alias("Note"), reason.alias("Error Message"))),
        )
        .when(kind == 3, F.to_json(F.struct(reason.alias("Information"))))
        .otherwise(F.lit("{}"))
    )
    return orders.select(
        F.concat(F.lit("C"), F.col("o_custkey")).alias("ticker"), payload.alias("raw_payload")
    )


def mixed_macro_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Macro responses of which two in three are error envelopes."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    kind = F.col("o_orderkey") % 3
    payload = (
        F.when(kind == 0, F.lit('{"observations": []}'))
        .when(kind == 1, F.to_json(F.struct(F.col("o_orderpriority").alias("error_message"))))
        .otherwise(F.lit("{}"))
    )
    return orders.select(
        F.concat(F.lit("M"), F.col("o_custkey")).alias("series_id"), payload.alias("raw_payload")
    )


def mixed_macro_bronze(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Macro responses landed as text on one day in four, else as structs of three kinds."""
    payload = f"{OBSERVATIONS_KEY} array<struct<date:string,value:string>>"
    rows = macro_responses(spark, sf_dir).withColumn("kind", F.dayofmonth("ingest_date") % 4)
    parsed = F.from_json("raw_payload", payload)
    points = parsed[OBSERVATIONS_KEY]
    noted = F.transform(points, lambda p: F.struct(p["value"], p["date"], F.lit("final").alias("status")))
    kinds = [
        F.col("raw_payload"),
        parsed,
        F.struct(F.lit("lin").alias("units"), points.alias(OBSERVATIONS_KEY)),
        F.struct(noted.alias(OBSERVATIONS_KEY), F.lit(1).alias("count")),
    ]
    for kind, column in enumerate(kinds):
        landed = rows.filter(F.col("kind") == kind).withColumn("raw_payload", column).drop("kind")
        landed.hint("rebalance", F.col("ingest_date")).write.mode("append").partitionBy("ingest_date").parquet(
            f"{path}/{MACRO_FEED.table}"
        )


def status_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per status and day, valid until the status has its next day: thousands of versions a key."""
    daily = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderstatus").alias("status"), F.col("o_orderdate").cast("date").alias("valid_from"))
        .agg(F.count(F.lit(1)).alias("placed"))
    )
    following = F.lead("valid_from").over(Window.partitionBy("status").orderBy("valid_from"))
    return daily.withColumn("valid_to", F.coalesce(following, F.lit("9999-12-31").cast("date")))


def shipped_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with one of the order statuses, a third each."""
    statuses = F.array(F.lit("F"), F.lit("O"), F.lit("P"))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", statuses[(F.col("l_orderkey") % 3).cast("int")].alias("status"),
        F.col("l_shipdate").cast("date").alias("day"),
    )


def placed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a time of day during the weeks of the events; a third of them at one and the same."""
    key = F.col("o_orderkey")
    second = F.when(key % 3 == 0, F.lit(1_000_000)).otherwise(key * 7919 % 2_764_800)
    start = F.unix_timestamp(F.lit("2023-12-31 00:00:00").cast("timestamp"))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.timestamp_seconds(start + second).alias("placed_at"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_id", "event_type")
