"""Small tables and payloads written by hand."""

from __future__ import annotations

import contextlib
import io
import json
from datetime import date, datetime
from decimal import Decimal

from tidemark.schemas import STOCK_PRICES


def day(text: str) -> date:
    return date.fromisoformat(text)


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def bar(close, volume="100", spread=1):
    close = Decimal(str(close))
    return {
        "1. open": str(close - spread),
        "2. high": str(close + spread),
        "3. low": str(close - 2 * spread),
        "4. close": str(close),
        "5. volume": volume,
    }


def price_bronze(spark, rows):
    """rows: (ticker, {day: bar}, ingested_at)"""
    data = [(t, json.dumps({"Time Series (Daily)": series}), i) for t, series, i in rows]
    return spark.createDataFrame(data, "ticker string, raw_payload string, ingested_at string")


def macro_bronze(spark, rows):
    """rows: (series, [(day, value)], ingested_at)"""
    data = [
        (s, json.dumps({"observations": [{"date": d, "value": v} for d, v in points]}), i)
        for s, points, i in rows
    ]
    return spark.createDataFrame(data, "series_id string, raw_payload string, ingested_at string")


def stocks(spark, rows):
    """rows: (ticker, day, close) or (ticker, day, close, volume)"""
    data = []
    for ticker, when, close, *volume in rows:
        price = None if close is None else Decimal(str(close))
        data.append((ticker, day(when), price, price, price, price, *(volume or [10]), at("2026-01-01")))
    return spark.createDataFrame(data, STOCK_PRICES)


def tuples(df, *columns):
    """All rows, sorted, NULLs first."""
    rows = [tuple(row) for row in df.select(*columns).collect()]
    return sorted(rows, key=lambda row: [(v is not None, v) for v in row])


def plan_of(df):
    """The physical plan as text, before adaptive changes."""
    printed = io.StringIO()
    with contextlib.redirect_stdout(printed):
        df.explain()
    return printed.getvalue()
