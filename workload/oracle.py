"""The registered queries once more, as SQL over the raw test tables.

The SQL never touches JSON: it computes from the relational columns what the Spark side computes
after writing and parsing payloads, so the two paths share no code.
"""

from __future__ import annotations

from workload.registry import DIGITS

# --- columns as portable text and numbers -------------------------------------------------------


def _date(*names: str) -> list[str]:
    return [f"strftime({name}, '%Y-%m-%d') AS {name}" for name in names]


def _time(*names: str) -> list[str]:
    return [f"strftime({name}, '%Y-%m-%d %H:%M:%S') AS {name}" for name in names]


def _exact(*names: str) -> list[str]:
    return [f"CAST({name} AS DOUBLE) AS {name}" for name in names]


def _real(*names: str) -> list[str]:
    return [f"round({name}, {DIGITS[name]}) AS {name}" for name in names]


def _whole(*names: str) -> list[str]:
    return [f"CAST({name} AS BIGINT) AS {name}" for name in names]


def _query(columns: list[str], source: str, *ctes: str) -> str:
    return f"WITH {', '.join(ctes)} SELECT {', '.join(columns)} FROM {source}"


# --- relations ----------------------------------------------------------------------------------

QUOTES = """
quotes AS (
    SELECT 'S' || l_suppkey AS ticker,
           CAST(l_shipdate AS DATE) AS trade_date,
           CAST(close_price - spread AS DECIMAL(18,4)) AS open_price,
           CAST(close_price + spread AS DECIMAL(18,4)) AS high_price,
           CAST(close_price - 2 * spread AS DECIMAL(18,4)) AS low_price,
           close_price,
           CAST(l_quantity AS BIGINT) AS volume,
           CAST(DATE '2026-01-01' + CAST(l_orderkey % 28 AS INTEGER) AS TIMESTAMP)
               + to_hours(l_linenumber) AS last_updated_at
    FROM (SELECT *, CAST(l_extendedprice AS DECIMAL(18,4)) AS close_price,
                    CAST(l_quantity AS DECIMAL(18,4)) AS spread
          FROM lineitem)
)"""

STOCKS = """
stocks AS (
    SELECT * FROM (
        SELECT *, row_number() OVER (
            PARTITION BY ticker, trade_date
            ORDER BY last_updated_at DESC, close_price DESC, open_price DESC, high_price DESC,
                     low_price DESC, volume DESC) AS place
        FROM quotes)
    WHERE place = 1
)"""

SUMMARY = """
rolled AS (
    SELECT *,
           CAST(sum(close_price) OVER week AS DOUBLE) / count(close_price) OVER week AS ma_7d,
           CAST(sum(close_price) OVER month AS DOUBLE) / count(close_price) OVER month AS ma_30d,
           stddev_samp(CAST(close_price AS DOUBLE)) OVER month AS volatility_30d,
           lag(close_price) OVER (PARTITION BY ticker ORDER BY trade_date) AS prev_close
    FROM stocks
    WINDOW week AS (PARTITION BY ticker ORDER BY trade_date ROWS 6 PRECEDING),
           month AS (PARTITION BY ticker ORDER BY trade_date ROWS 29 PRECEDING)
),
summary AS (
    SELECT *, close_price - prev_close AS daily_change,
           CASE WHEN prev_close > 0 THEN (close_price - prev_close) / prev_close * 100 END
               AS daily_return_pct
    FROM rolled
)"""

OBSERVED = """
ordered AS (
    SELECT o_orderkey, o_orderpriority,
           CASE o_orderpriority WHEN '1-URGENT' THEN 'FEDFUNDS' WHEN '2-HIGH' THEN 'CPIAUCSL'
                WHEN '5-LOW' THEN 'GDP' ELSE 'UNRATE' END AS series_id,
           CAST(date_trunc(CASE o_orderpriority WHEN '5-LOW' THEN 'quarter' ELSE 'month' END, o_orderdate)
                AS DATE) AS first_day,
           CAST(o_totalprice AS DECIMAL(18,4)) AS price,
           CAST(DATE '2026-01-01' + CAST(o_orderkey % 28 AS INTEGER) AS TIMESTAMP)
               + to_hours(CAST(o_custkey % 24 AS INTEGER)) AS last_updated_at
    FROM orders
),
reported AS (
    SELECT *, CASE WHEN series_id = 'GDP' THEN first_day + 14 ELSE first_day END AS dated,
           CASE WHEN series_id = 'GDP' THEN 3 ELSE 1 END AS step
    FROM ordered
),
observed AS (
    SELECT series_id, CAST(dated AS DATE) AS observation_date, price AS value, last_updated_at
    FROM reported WHERE o_orderpriority <> '4-NOT SPECIFIED'
    UNION ALL
    SELECT series_id, CAST(dated - to_months(step) AS DATE),
           CAST(price + 1 AS DECIMAL(18,4)), last_updated_at
    FROM reported
)"""

INDICATORS = """
indicators AS (
    SELECT series_id, observation_date,
           arg_max(value, (last_updated_at, value)) AS value,
           max(last_updated_at) AS last_updated_at
    FROM observed GROUP BY series_id, observation_date
)"""

PIVOT = """
macro AS (
    SELECT observation_date,
           max(value) FILTER (series_id = 'FEDFUNDS') AS fed_funds_rate,
           max(value) FILTER (series_id = 'CPIAUCSL') AS cpi,
           max(value) FILTER (series_id = 'UNRATE') AS unemployment_rate,
           max(value) FILTER (series_id = 'GDP') AS gdp
    FROM indicators GROUP BY observation_date
)"""

COMPANY = """
recorded AS (
    SELECT 'S' || s_suppkey AS ticker, s_name AS company_name, r_name AS sector,
           CASE WHEN s_acctbal < 0 THEN 'NYSE' ELSE 'NASDAQ' END AS exchange,
           make_date(year, 1, 1) AS effective_date
    FROM (SELECT unnest(generate_series(1995, 2001)) AS year) AS years
    JOIN supplier ON true
    JOIN nation ON s_nationkey = n_nationkey
    JOIN region ON r_regionkey = (n_regionkey + ((year - 1995) // 2) * (s_suppkey % 3)) % 5
),
islands AS (
    SELECT *, sum(moved) OVER (PARTITION BY ticker ORDER BY effective_date) AS island
    FROM (SELECT *, CASE WHEN (company_name, sector, exchange) IS DISTINCT FROM
                 lag((company_name, sector, exchange))
                     OVER (PARTITION BY ticker ORDER BY effective_date)
                 THEN 1 ELSE 0 END AS moved
          FROM recorded)
),
versions AS (
    SELECT ticker, any_value(company_name) AS company_name, any_value(sector) AS sector,
           any_value(exchange) AS exchange, min(effective_date) AS effective_date,
           CAST(min(effective_date) AS TIMESTAMP) AS dbt_valid_from
    FROM islands GROUP BY ticker, island
),
snapshot AS (
    SELECT *, lead(dbt_valid_from) OVER (PARTITION BY ticker ORDER BY dbt_valid_from)
               AS dbt_valid_to
    FROM versions
),
company AS (
    SELECT ticker, company_name, sector, exchange, effective_date,
           dbt_valid_from AS valid_from,
           CASE WHEN dbt_valid_to IS NULL THEN TIMESTAMP '9999-12-31 23:59:59'
                ELSE dbt_valid_to END AS valid_to,
           dbt_valid_to IS NULL AS is_current
    FROM snapshot
)"""

SECTORS = """
sectors AS (
    SELECT trade_date, sector,
           count(DISTINCT summary.ticker) AS num_companies,
           avg(daily_return_pct) AS avg_daily_return_pct,
           sum(volume) AS total_volume,
           CAST(sum(close_price) AS DOUBLE) / count(close_price) AS avg_close_price,
           min(close_price) AS min_close_price,
           max(close_price) AS max_close_price
    FROM summary JOIN company ON summary.ticker = company.ticker
     AND trade_date BETWEEN CAST(valid_from AS DATE) AND CAST(valid_to AS DATE) - 1
    GROUP BY trade_date, sector
)"""

DAILY = """
daily AS (
    SELECT trade_date, avg(daily_return_pct) AS market_avg_return,
           sum(volume) AS market_total_volume, count(DISTINCT ticker) AS num_tickers
    FROM summary GROUP BY trade_date
)"""

MARKET = """
market AS (
    SELECT daily.*, macro.* EXCLUDE (observation_date),
           macro.observation_date AS macro_observation_date
    FROM daily ASOF LEFT JOIN macro ON daily.trade_date >= macro.observation_date
)"""

_STOCKS = (QUOTES, STOCKS)
_SUMMARY = (*_STOCKS, SUMMARY)
_INDICATORS = (OBSERVED, INDICATORS)
_SECTORS = (*_SUMMARY, COMPANY, SECTORS)
_MARKET = (*_SUMMARY, DAILY, *_INDICATORS, PIVOT, MARKET)

# --- results ------------------------------------------------------------------------------------

_PRICES = ["open_price", "high_price", "low_price", "close_price"]
_STOCK_COLUMNS = [
    "ticker", *_date("trade_date"), *_exact(*_PRICES), "volume", *_time("last_updated_at"),
]
_INDICATOR_COLUMNS = [
    "series_id", *_date("observation_date"), *_exact("value"), *_time("last_updated_at"),
]
_COMPANY_COLUMNS = [
    "ticker", "company_name", "sector", "exchange", *_date("effective_date"),
    *_time("valid_from", "valid_to"), "is_current",
]
_SUMMARY_COLUMNS = [
    "ticker", *_date("trade_date"), *_exact(*_PRICES), "volume",
    "ma_7d", "ma_30d", *_real("volatility_30d"), *_exact("daily_change"), "daily_return_pct",
]
_SECTOR_COLUMNS = [
    *_date("trade_date"), "sector", "num_companies", *_real("avg_daily_return_pct"),
    *_whole("total_volume"), "avg_close_price",
    *_exact("min_close_price", "max_close_price"),
]
_MACRO_NAMES = ["fed_funds_rate", "cpi", "unemployment_rate", "gdp"]
_DAILY_COLUMNS = [
    *_date("trade_date"), *_real("market_avg_return"), *_whole("market_total_volume"), "num_tickers",
]
_MARKET_COLUMNS = [*_DAILY_COLUMNS, *_exact(*_MACRO_NAMES), *_date("macro_observation_date")]

_TEST_COLUMNS = 'SELECT \'{0}\' AS "check", \'{1}\' AS "table", \'{2}\' AS "column"'


def _tests() -> str:
    """Every declared test, written out as one counting query each."""
    not_null = {
        "stocks": ("stg_stock_prices", ["ticker", "trade_date", *_PRICES, "volume"]),
        "indicators": ("stg_macro_indicators", ["series_id", "observation_date", "value"]),
        "summary": ("daily_price_summary", ["ticker", "trade_date", "close_price"]),
        "sectors": ("sector_performance", ["trade_date", "sector"]),
        "market": ("macro_market_correlation", ["trade_date"]),
    }
    unique = {
        "stocks": ("stg_stock_prices", "ticker,trade_date"),
        "indicators": ("stg_macro_indicators", "series_id,observation_date"),
    }
    counts = [
        f"{_TEST_COLUMNS.format('not_null', table, column)},"
        f" (SELECT count(*) FROM {relation} WHERE {column} IS NULL) AS failures"
        for relation, (table, columns) in not_null.items()
        for column in columns
    ]
    counts += [
        f"{_TEST_COLUMNS.format('unique_combination', table, keys)}, (SELECT count(*) FROM"
        f" (SELECT {keys} FROM {relation} GROUP BY {keys} HAVING count(*) > 1)) AS failures"
        for relation, (table, keys) in unique.items()
    ]
    ctes = (*_SUMMARY, COMPANY, SECTORS, DAILY, *_INDICATORS, PIVOT, MARKET)
    return _query(["*", "failures = 0 AS passed"], f"({' UNION ALL '.join(counts)})", *ctes)


def _raw_tests() -> str:
    columns = ["close_price", "volatility_30d", "prev_close"]
    counts = [
        f"{_TEST_COLUMNS.format('not_null', 'rolling', column)},"
        f" (SELECT count(*) FROM rolled WHERE {column} IS NULL) AS failures"
        for column in columns
    ]
    counts.append(
        f"{_TEST_COLUMNS.format('unique_combination', 'quotes', 'ticker,trade_date')},"
        " (SELECT count(*) FROM (SELECT ticker, trade_date FROM quotes"
        " GROUP BY ticker, trade_date HAVING count(*) > 1)) AS failures"
    )
    return _query(["*", "failures = 0 AS passed"], f"({' UNION ALL '.join(counts)})", *_SUMMARY)


_ENVELOPES = """
    SELECT 'daily_prices_raw' AS feed, 'C' || o_custkey AS name,
           'Unexpected response for C' || o_custkey || ': ' ||
           CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 4 THEN 'Unknown error'
                               ELSE o_orderpriority END AS error
    FROM orders
    UNION ALL
    SELECT 'fred_series_raw', 'M' || o_custkey,
           'Unexpected response for M' || o_custkey || ': ' ||
           CASE o_orderkey % 3 WHEN 0 THEN NULL WHEN 1 THEN o_orderpriority
                               ELSE 'Unknown error' END
    FROM orders"""

_LANDING = """
    SELECT CASE WHEN o_orderkey % 5 = 0 THEN 'landed' ELSE 'rejected' END AS outcome,
           '2026-01-05T22:15:00+00:00' AS ingested_at,
           CASE WHEN o_orderkey % 5 = 0 THEN 'TIME_SERIES_DAILY' END AS api_function,
           CASE WHEN o_orderkey % 5 = 0 THEN '2026-01-05' END AS ingest_date,
           count(*) AS responses, count(DISTINCT o_custkey) AS tickers
    FROM orders GROUP BY ALL"""

# The same, where equal responses have been landed once.
_LANDING_ONCE = """
    SELECT outcome, '2026-01-05T22:15:00+00:00' AS ingested_at,
           CASE WHEN outcome = 'landed' THEN 'TIME_SERIES_DAILY' END AS api_function,
           CASE WHEN outcome = 'landed' THEN '2026-01-05' END AS ingest_date,
           count(*) AS responses, count(DISTINCT o_custkey) AS tickers
    FROM (SELECT DISTINCT o_custkey, o_orderkey % 5 AS kind, CASE WHEN o_orderkey % 5 = 0 THEN 'landed' ELSE 'rejected' END AS outcome,
                 CASE WHEN o_orderkey % 5 IN (1, 2, 3) THEN o_orderpriority END AS reason FROM orders)
    GROUP BY ALL"""

_MACRO_LANDING = """
    SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'landed' ELSE 'rejected' END AS outcome,
           CASE WHEN o_orderkey % 3 = 0 THEN 'fred' END AS source,
           CASE o_orderkey % 3 WHEN 1 THEN o_orderpriority WHEN 2 THEN 'Unknown error' END AS error,
           count(*) AS responses, count(DISTINCT o_custkey) AS series, true AS run_failed
    FROM orders GROUP BY ALL"""

_BRONZE_SCAN = """
    SELECT strftime(DATE '2026-01-01' + CAST(l_orderkey % 28 AS INTEGER), '%Y-%m-%d')
               AS ingest_date,
           'alpha_vantage' AS source, 'TIME_SERIES_DAILY' AS api_function,
           count(*) AS responses, count(DISTINCT l_suppkey) AS tickers
    FROM lineitem GROUP BY 1"""

_PARTITIONS = """
    SELECT DISTINCT strftime(DATE '2026-01-01' + CAST(l_orderkey % 28 AS INTEGER), '%Y-%m-%d')
               AS ingest_date
    FROM lineitem"""

_JSON = """
    SELECT event_id, json_exists(props, '$.k') AS has_k, json_exists(props, '$.j') AS has_j,
           json_extract_string(props, '$.k') AS k_text,
           CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
    FROM events"""

_MARTS = """(
    WITH valued AS (
        SELECT summary.trade_date, recorded.sector, daily_return_pct, volume
        FROM summary JOIN recorded ON summary.ticker = recorded.ticker
        WHERE effective_date = DATE '1995-01-01' AND trade_date >= DATE '1998-01-01'
    )
    SELECT 'daily_price_summary' AS "table", ticker AS name,
           strftime(trade_date, '%Y-%m-%d') AS trade_date, daily_return_pct AS return_pct,
           CAST(volume AS BIGINT) AS volume, CAST(1 AS BIGINT) AS n
    FROM summary
    UNION ALL
    SELECT 'sector_performance', sector, strftime(trade_date, '%Y-%m-%d'),
           round(avg(daily_return_pct), 6), CAST(sum(volume) AS BIGINT), count(*)
    FROM valued GROUP BY trade_date, sector
    UNION ALL
    SELECT 'macro_market_correlation', strftime(macro_observation_date, '%Y-%m-%d'),
           strftime(trade_date, '%Y-%m-%d'), round(market_avg_return, 6),
           CAST(market_total_volume AS BIGINT), num_tickers
    FROM market)"""

_BUILT = """(
    WITH valued AS (
        SELECT summary.trade_date, recorded.sector, daily_return_pct, volume
        FROM summary JOIN recorded ON summary.ticker = recorded.ticker
        WHERE effective_date = DATE '1995-01-01' AND trade_date >= DATE '1998-01-01'
    ), counts AS (
        SELECT 'company_metadata' AS name, count(*) AS n FROM supplier
        UNION ALL SELECT 'dim_company_snapshot', count(*) FROM supplier
        UNION ALL SELECT 'dim_company', count(*) FROM supplier
        UNION ALL SELECT 'stg_stock_prices', count(*) FROM stocks
        UNION ALL SELECT 'stg_macro_indicators', count(*) FROM indicators
        UNION ALL SELECT 'daily_price_summary', count(*) FROM summary
        UNION ALL SELECT 'macro_market_correlation', count(*) FROM market
        UNION ALL SELECT 'sector_performance', count(DISTINCT (trade_date, sector)) FROM valued
    )
    SELECT 'daily_price_summary' AS "table", ticker AS name,
           strftime(trade_date, '%Y-%m-%d') AS trade_date, daily_return_pct AS return_pct,
           CAST(volume AS BIGINT) AS volume, CAST(1 AS BIGINT) AS n
    FROM summary
    UNION ALL
    SELECT 'sector_performance', sector, strftime(trade_date, '%Y-%m-%d'),
           round(avg(daily_return_pct), 6), CAST(sum(volume) AS BIGINT), count(*)
    FROM valued GROUP BY trade_date, sector
    UNION ALL
    SELECT 'macro_market_correlation', strftime(macro_observation_date, '%Y-%m-%d'),
           strftime(trade_date, '%Y-%m-%d'), round(market_avg_return, 6),
           CAST(market_total_volume AS BIGINT), num_tickers
    FROM market
    UNION ALL
    SELECT 'rows', name, NULL, NULL, NULL, n FROM counts)"""

_SNAPSHOT_COLUMNS = [
    "ticker", "company_name", "sector", "exchange", *_date("effective_date"),
    "md5(ticker || '|' || strftime(dbt_valid_from, '%Y-%m-%d %H:%M:%S')) AS dbt_scd_id",
    "strftime(dbt_valid_from, '%Y-%m-%d %H:%M:%S') AS dbt_updated_at",
    *_time("dbt_valid_from", "dbt_valid_to"),
]

_stocks = _query(_STOCK_COLUMNS, "stocks", *_STOCKS)
_indicators = _query(_INDICATOR_COLUMNS, "indicators", *_INDICATORS)

SQL: dict[str, str] = {
    "stg_stock_prices": _stocks,
    "stg_macro_indicators": _indicators,
    "dim_company": _query(_COMPANY_COLUMNS, "company", COMPANY),
    "daily_price_summary": _query(_SUMMARY_COLUMNS, "summary", *_SUMMARY),
    "sector_performance": _query(_SECTOR_COLUMNS, "sectors", *_SECTORS),
    "macro_market_correlation": _query(_MARKET_COLUMNS, "market", *_MARKET),
    "price_bars": _query(_STOCK_COLUMNS, "quotes", QUOTES),
    "macro_observations": _query(_INDICATOR_COLUMNS, "observed", OBSERVED),
    "macro_struct_payload": _indicators,
    "json_extract": _JSON,
    "latest_by_key": _query(
        [
            "ticker", *_date("trade_date"), *_exact(*_PRICES), "volume",
            "strftime(last_updated_at, '%Y-%m-%dT%H:%M:%S') AS ingested_at",
        ],
        "stocks",
        *_STOCKS,
    ),
    "rolling_metrics": _query(
        [
            "ticker", *_date("trade_date"), *_exact("close_price"),
            "ma_7d", "ma_30d", *_real("volatility_30d"), *_exact("prev_close"),
        ],
        "rolled",
        *_SUMMARY,
    ),
    "pit_join": _query(
        ["quotes.ticker", *_date("trade_date"), *_exact("close_price"), "sector"],
        "quotes JOIN company ON quotes.ticker = company.ticker AND trade_date BETWEEN"
        " CAST(valid_from AS DATE) AND CAST(valid_to AS DATE) - 1",
        QUOTES,
        COMPANY,
    ),
    "asof_join": _query(
        ["o_orderkey", *_date("day", "observation_date"), *_exact(*_MACRO_NAMES)],
        "(SELECT o_orderkey, CAST(o_orderdate AS DATE) - 90 AS day FROM orders) AS placed"
        " ASOF LEFT JOIN macro ON placed.day >= macro.observation_date",
        *_INDICATORS,
        PIVOT,
    ),
    "macro_pivot": _query(
        [*_date("observation_date"), *_exact(*_MACRO_NAMES)], "macro", *_INDICATORS, PIVOT
    ),
    "market_daily": _query(_DAILY_COLUMNS, "daily", *_SUMMARY, DAILY),
    "scd2_snapshot": _query(_SNAPSHOT_COLUMNS, "snapshot", COMPANY),
    "scd2_merge": _query(_COMPANY_COLUMNS, "company", COMPANY),
    "scd2_late_runs": _query(_COMPANY_COLUMNS, "company", COMPANY),
    "top_recent_prices": _query(
        [
            "ticker", *_date("trade_date"), *_exact("close_price"), "ma_7d", "daily_return_pct",
        ],
        "(SELECT * FROM summary ORDER BY trade_date DESC, ticker LIMIT 10) AS newest",
        *_SUMMARY,
    ),
    "ticker_history": _query(
        [
            "ticker", *_date("trade_date"), *_exact("close_price"),
            "ma_7d", "ma_30d", *_real("volatility_30d"), "daily_return_pct",
        ],
        "(SELECT * FROM summary WHERE ticker = 'S7' ORDER BY trade_date DESC LIMIT 10) AS newest",
        *_SUMMARY,
    ),
    "sector_ranking": _query(
        [
            *_date("trade_date"), "sector", "num_companies", *_real("avg_daily_return_pct"),
            *_whole("total_volume"),
        ],
        "sectors ORDER BY sectors.trade_date DESC, sectors.avg_daily_return_pct DESC",
        *_SECTORS,
    ),
    "sector_by_day": _query(
        _SECTOR_COLUMNS, "sectors ORDER BY sectors.trade_date DESC, sector", *_SECTORS
    ),
    "macro_context": _query(
        [
            *_date("trade_date"), *_real("market_avg_return"),
            *_exact("fed_funds_rate", "unemployment_rate", "cpi"),
        ],
        "(SELECT * FROM market ORDER BY trade_date DESC LIMIT 10) AS newest",
        *_MARKET,
    ),
    "market_by_day": _query(_MARKET_COLUMNS, "market ORDER BY market.trade_date DESC", *_MARKET),
    "company_history": _query(
        ["ticker", "company_name", "sector", *_time("valid_from", "valid_to"), "is_current"],
        "company WHERE ticker = 'S7'",
        COMPANY,
    ),
    "bronze_envelope": _ENVELOPES,
    "bronze_landing": _LANDING,
    "macro_landing": _MACRO_LANDING,
    "bronze_partitions": _PARTITIONS,
    "bronze_scan": _BRONZE_SCAN,
    "seed_load": _query(
        ["ticker", "company_name", "sector", "exchange", *_date("effective_date")],
        "recorded WHERE recorded.effective_date = DATE '1995-01-01'",
        COMPANY,
    ),
    "dq_column_tests": _tests(),
    "dq_raw_tests": _raw_tests(),
    "dq_freshness": _query(
        [
            "strftime(latest, '%Y-%m-%d') AS latest_ingest",
            "CAST(DATE '2026-01-31' - latest AS INTEGER) AS days_stale",
            "DATE '2026-01-31' - latest <= 3 AS passed",
        ],
        "(SELECT CAST(max(last_updated_at) AS DATE) AS latest FROM quotes) AS newest",
        QUOTES,
    ),
    "dq_volume": _query(
        ["count(DISTINCT ticker) AS ticker_count"],
        "quotes WHERE trade_date = (SELECT max(trade_date) FROM quotes)",
        QUOTES,
    ),
    "dq_negative": _query(
        ["count(*) AS negative_count"],
        "quotes WHERE least(open_price, high_price, low_price, close_price) < 20000",
        QUOTES,
    ),
    "incremental_silver": _stocks,
    "stream_silver_prices": _stocks,
    "stream_silver_macro": _indicators,
    "stream_micro_batches": _indicators,
    "dq_report": _query(
        ["*"],
        """(
            SELECT 'freshness' AS "check", DATE '2026-01-31' - newest AS measured,
                   DATE '2026-01-31' - newest <= 3 AS passed
            FROM (SELECT CAST(max(last_updated_at) AS DATE) AS newest FROM quotes)
            UNION ALL
            SELECT 'ticker_count', n, n BETWEEN 2 AND 20 FROM (
                SELECT count(DISTINCT ticker) AS n FROM quotes
                WHERE trade_date = (SELECT max(trade_date) FROM quotes))
            UNION ALL
            SELECT 'negative_prices', n, n = 0 FROM (
                SELECT count(*) AS n FROM stocks
                WHERE least(open_price, high_price, low_price, close_price) < 0))""",
        *_STOCKS,
    ),
    "stored_periods": _query(
        ["strftime(trade_date, '%Y-%m') AS period", "count(*) AS row_count"],
        "stocks GROUP BY 1",
        *_STOCKS,
    ),
    "medallion_build": _query(["*"], _BUILT, *_MARKET, COMPANY),
    "incremental_gold": _query(["*"], _MARTS, *_MARKET, COMPANY),
    "asof_intraday": """
        SELECT o_orderkey, strftime(placed_at, '%Y-%m-%d %H:%M:%S') AS placed_at, event_id, event_type
        FROM (SELECT o_orderkey, TIMESTAMP '2023-12-31'
                     + to_seconds(CASE WHEN o_orderkey % 3 = 0 THEN 1000000 ELSE o_orderkey * 7919 % 2764800 END) AS placed_at
              FROM orders) AS placed
        ASOF LEFT JOIN (SELECT ts, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type
                        FROM events GROUP BY ts) AS latest ON placed.placed_at >= latest.ts""",
    "pit_join_versions": """
        WITH daily AS (
            SELECT o_orderstatus AS status, CAST(o_orderdate AS DATE) AS valid_from, count(*) AS placed
            FROM orders GROUP BY ALL
        ), versions AS (
            SELECT *, coalesce(lead(valid_from) OVER (PARTITION BY status ORDER BY valid_from), DATE '9999-12-31') AS valid_to
            FROM daily
        ), lines AS (
            SELECT l_orderkey, l_linenumber, ['F', 'O', 'P'][CAST(l_orderkey % 3 AS INTEGER) + 1] AS status, CAST(l_shipdate AS DATE) AS day
            FROM lineitem
        )
        SELECT l_orderkey, l_linenumber, lines.status, strftime(day, '%Y-%m-%d') AS day, placed,
               strftime(valid_from, '%Y-%m-%d') AS valid_from
        FROM lines JOIN versions ON lines.status = versions.status AND day >= valid_from AND day < valid_to""",
    "struct_bronze_silver": _indicators,
    "struct_bronze_stream": _indicators,
}

SQL |= {
    "bronze_landing_retry": _LANDING_ONCE,
    "stream_landing": _LANDING_ONCE,
    "recent_prices_stored": SQL["top_recent_prices"],
    "dq_volume_stored": SQL["dq_volume"],
    "variant_bars": SQL["price_bars"],
}
