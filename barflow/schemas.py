"""Explicit schemas for every scan and sink; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "BIGINT": T.LongType(),
    "INT": T.IntegerType(),
    "DOUBLE": T.DoubleType(),
    "STRING": T.StringType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
}


def schema_of(columns: str) -> T.StructType:
    """``name TYPE, …`` as a schema; unlike Spark's own parser this needs no session."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


BAR_DDL = (
    "ts BIGINT, iso_ts STRING, symbol STRING, interval STRING, "
    "open DOUBLE, high DOUBLE, low DOUBLE, close DOUBLE, volume DOUBLE"
)
BAR_SCHEMA = schema_of(BAR_DDL)
BAR_COLUMNS = tuple(BAR_SCHEMA.fieldNames())

TICK_SCHEMA = schema_of(
    "ts BIGINT, iso_ts STRING, symbol STRING, price DOUBLE, event_type STRING, source STRING"
)
TICK_CSV_COLUMNS = ("ts", "iso_ts", "symbol", "price")

ENVELOPE_SCHEMA = schema_of(
    "topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP, "
    "timestampType INT, key STRING, value STRING"
)

CANDLE_COLUMNS = ("day", "symbol", "open", "high", "low", "close", "volume", "rows")
CANDLE_SCHEMA = schema_of(
    "day DATE, symbol STRING, open DOUBLE, high DOUBLE, low DOUBLE, close DOUBLE, "
    "volume DOUBLE, rows BIGINT"
)

VALID_BAR_SCHEMA = schema_of(
    "symbol STRING, open_ts TIMESTAMP, open DOUBLE, high DOUBLE, low DOUBLE, "
    "close DOUBLE, volume DOUBLE, date DATE"
)

FORECAST_SCHEMA = schema_of("symbol STRING, ds DATE, y_hat_close DOUBLE")

MACRO_SCHEMA = schema_of(
    "source STRING, event_type STRING, event_name STRING, event_date STRING, "
    "event_time_utc STRING, actual STRING, forecast STRING, previous STRING, units STRING"
).add("extra", schema_of("local_time_str STRING, period_month STRING"))
MACRO_EVENT_SCHEMA = schema_of(
    "event_name STRING, event_date DATE, event_time_utc STRING, actual DOUBLE, "
    "forecast DOUBLE, previous DOUBLE, units STRING, period_month STRING, "
    "local_time_str STRING, event_id STRING, source STRING, event_type STRING, "
    "event_year INT, event_month INT"
)

SENTIMENT_EVENT_SCHEMA = T.StructType(
    [
        *MACRO_EVENT_SCHEMA.fields[:10],
        *schema_of("event_delta DOUBLE, event_sentiment INT").fields,
        *MACRO_EVENT_SCHEMA.fields[10:],
    ]
)

POST_SCHEMA = schema_of("date STRING, text STRING, id STRING")
SCORED_POST_SCHEMA = schema_of(
    "event_type STRING, platform STRING, user_handle STRING, truth_id STRING, "
    "truth_url STRING, created_at STRING, event_date STRING, raw_text STRING, "
    "language STRING, is_economic BOOLEAN, economic_categories STRING, "
    "sentiment_score DOUBLE, sentiment_label STRING, sentiment_index INT, "
    "market_bias STRING, ingested_at STRING"
)

CLOSE_SCHEMA = schema_of("date DATE, close DOUBLE")
DAILY_BAR_SCHEMA = schema_of("iso_ts STRING, symbol STRING, close DOUBLE")
