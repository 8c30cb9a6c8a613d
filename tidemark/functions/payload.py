"""Column expressions over raw JSON payloads. Each payload is parsed once, then exploded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import OBSERVATIONS_KEY, PRICE_BAR_FIELDS, PRICE_SERIES_KEY

_BAR = T.StructType([T.StructField(name, T.StringType()) for name in PRICE_BAR_FIELDS.values()])
_PRICE_PAYLOAD = T.StructType(
    [T.StructField(PRICE_SERIES_KEY, T.MapType(T.StringType(), _BAR))]
)
_OBSERVATION = T.StructType(
    [T.StructField("date", T.StringType()), T.StructField("value", T.StringType())]
)
_MACRO_PAYLOAD = T.StructType([T.StructField(OBSERVATIONS_KEY, T.ArrayType(_OBSERVATION))])

# A payload that is not valid JSON fails the job instead of turning into NULL and vanishing;
# landing has already set such responses aside.
_STRICT = {"mode": "FAILFAST"}


def payload_text(df: DataFrame, column: str = "raw_payload") -> Column:
    """The payload as JSON text, whether it was landed as text or as a nested struct."""
    if isinstance(df.schema[column].dataType, T.StringType):
        return F.col(column)
    return F.to_json(F.col(column))


def daily_bars(payload: Column) -> Column:
    """Price payload -> map of date text to bar struct; the keys are only known at run time."""
    return F.from_json(payload, _PRICE_PAYLOAD, _STRICT)[PRICE_SERIES_KEY]


def observations(payload: Column) -> Column:
    """Macro payload -> array of (date, value) texts."""
    return F.from_json(payload, _MACRO_PAYLOAD, _STRICT)[OBSERVATIONS_KEY]


def has_key(payload: Column, key: str) -> Column:
    """True if the payload is a JSON object with this top-level key, whatever its value."""
    return F.coalesce(F.array_contains(F.json_object_keys(payload), key), F.lit(False))


def first_text(payload: Column, *keys: str) -> Column:
    """The first of the top-level keys that holds a non-empty text."""
    texts = [F.nullif(F.get_json_object(payload, f"$['{key}']"), F.lit("")) for key in keys]
    return F.coalesce(*texts)


def integral(text: Column) -> Column:
    """Text to bigint, accepting spellings such as 5.7 or 1e3 by rounding to a whole number."""
    return text.cast(T.DecimalType(38, 0)).cast("bigint")


def variant_bars(bronze: DataFrame, *carried: str) -> DataFrame:
    """``carried`` columns with (day, bar), the bar as VARIANT: no field of a bar has to be declared.

    The payload is parsed once into VARIANT; the days are its keys. A payload that is not valid JSON
    fails the job, as with ``daily_bars``.
    """
    parsed = F.parse_json(payload_text(bronze))
    series = bronze.select(*carried, F.variant_get(parsed, f'$["{PRICE_SERIES_KEY}"]', "variant").alias("_series"))
    days = bronze.sparkSession.tvf.variant_explode(F.col("_series").outer())
    return series.lateralJoin(days).select(*carried, F.col("key").alias("day"), F.col("value").alias("bar"))


def variant_text(bar: Column, field: str) -> Column:
    """A field of a VARIANT bar as text, whatever JSON type it has."""
    return F.variant_get(bar, f'$["{field}"]', "string")
