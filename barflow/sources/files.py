"""File scans with explicit schemas. A filter on a partition column prunes directories."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barflow.functions.textcols import strip
from barflow.functions.timecols import as_date
from barflow.schemas import (
    BAR_SCHEMA,
    CANDLE_COLUMNS,
    CANDLE_SCHEMA,
    CLOSE_SCHEMA,
    DAILY_BAR_SCHEMA,
    ENVELOPE_SCHEMA,
    MACRO_EVENT_SCHEMA,
    MACRO_SCHEMA,
    POST_SCHEMA,
    SCORED_POST_SCHEMA,
    SENTIMENT_EVENT_SCHEMA,
    VALID_BAR_SCHEMA,
    schema_of,
)

FORMATS = ("parquet", "json")


def check_format(fmt: str) -> str:
    if fmt not in FORMATS:
        raise ValueError(f"unsupported format {fmt!r}; use one of {FORMATS}")
    return fmt


def _with_partitions(schema: T.StructType, ddl: str) -> T.StructType:
    extra = schema_of(ddl)
    data = [f for f in schema.fields if f.name not in extra.fieldNames()]
    return T.StructType([*data, *extra.fields])


def _headered(spark: SparkSession, schema: T.StructType):
    """A reader that fails on a header with other names or another order than the schema, instead of
    reading by position."""
    return spark.read.schema(schema).option("header", "true").option("enforceSchema", "false")


def raw_scan(spark: SparkSession, base: str, fmt: str = "parquet") -> DataFrame:
    """The whole raw lake, laid out as ``topic=…/date=…``."""
    schema = _with_partitions(ENVELOPE_SCHEMA, "topic STRING, date DATE")
    return spark.read.schema(schema).format(check_format(fmt)).load(base)


def raw_day_scan(
    spark: SparkSession,
    base: str,
    day: str | date,
    topic: str | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Raw rows that can belong to a local day: its date partition and both neighbours.

    A local day overlaps two UTC dates, so one partition alone would lose rows. ``topic`` limits
    the read to one topic, otherwise every topic is read.
    """
    d = as_date(day)
    near = F.col("date").between(F.lit(d - timedelta(days=1)), F.lit(d + timedelta(days=1)))
    df = raw_scan(spark, base, fmt).where(near)
    return df if topic is None else df.where(F.col("topic") == topic)


def gold_scan(spark: SparkSession, base: str) -> DataFrame:
    """Daily candles, laid out as ``day=…/symbol=…``."""
    return spark.read.schema(CANDLE_SCHEMA).parquet(base).select(*CANDLE_COLUMNS)


def silver_scan(spark: SparkSession, base: str, fmt: str = "parquet", interval: bool = False) -> DataFrame:
    """Validated bars, laid out as ``symbol=…/year=…/month=…``, below ``interval=…`` if ``interval``."""
    width = "interval STRING, " if interval else ""
    schema = _with_partitions(VALID_BAR_SCHEMA, f"{width}symbol STRING, year INT, month INT")
    return _headered(spark, schema).format(fmt).load(base)


def forecast_scan(spark: SparkSession, base: str, errors: bool = True) -> DataFrame:
    """Forecasts, laid out as ``ds=…/symbol=…``, with or without the error columns."""
    values = "y_hat_close DOUBLE, " + (
        "actual_close DOUBLE, abs_error DOUBLE, ape DOUBLE, " if errors else ""
    )
    schema = schema_of(values + "created_at TIMESTAMP, ds DATE, symbol STRING")
    return _headered(spark, schema).csv(base)


def scored_post_scan(spark: SparkSession, base: str) -> DataFrame:
    """Scored posts, laid out as ``event_date=…``; texts may hold line breaks and quotes."""
    schema = _with_partitions(SCORED_POST_SCHEMA, "event_date STRING")
    reader = _headered(spark, schema).option("escape", '"')
    df = reader.option("multiLine", "true").csv(base)
    return df.select(*SCORED_POST_SCHEMA.fieldNames())


def bar_csv_scan(
    spark: SparkSession, base: str | Sequence[str], partitions: str | None = None
) -> DataFrame:
    """Bars from headered CSV, over every partition below ``base``.

    ``partitions`` is the DDL of columns that live in directory names, such as
    ``interval STRING, symbol STRING, month STRING``.
    """
    schema = _with_partitions(BAR_SCHEMA, partitions) if partitions else BAR_SCHEMA
    return _headered(spark, schema).csv(base)


def daily_csv_scan(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``iso_ts, symbol, close`` rows of headered CSV files, found by name.

    The header may list more columns and in any order; a missing one is an error.
    """
    names = DAILY_BAR_SCHEMA.fieldNames()
    header = spark.read.option("header", "true").csv(path).columns
    missing = sorted(set(names) - set(header))
    if missing:
        raise ValueError(f"missing columns {missing}; found {header}")
    types = {f.name: f.dataType for f in DAILY_BAR_SCHEMA.fields}
    schema = T.StructType([T.StructField(n, types.get(n, T.StringType())) for n in header])
    return spark.read.schema(schema).option("header", "true").csv(path).select(*names)


def event_csv_scan(
    spark: SparkSession, base: str, source: str | None = None, sentiment: bool = False
) -> DataFrame:
    """Flat macro events from the partitioned event lake, optionally of one source.

    ``sentiment`` reads the two columns that sentiment rows carry in addition.
    """
    schema = SENTIMENT_EVENT_SCHEMA if sentiment else MACRO_EVENT_SCHEMA
    df = spark.read.schema(schema).option("header", "true").option("escape", '"').csv(base)
    return df if source is None else df.where(F.col("source") == source)


def macro_jsonl_scan(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Macro releases from JSON lines; fields a line lacks are null."""
    return spark.read.schema(MACRO_SCHEMA).json(path)


def post_jsonl_scan(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Posts from JSON lines; blank, malformed, dateless and textless lines are dropped. A post's own ``id`` is optional."""
    df = spark.read.schema(POST_SCHEMA).option("mode", "DROPMALFORMED").json(path)
    return df.where((F.length("date") > 0) & (F.length(strip(F.col("text"))) > 0))


def close_csv_scan(
    spark: SparkSession, path: str | Sequence[str], symbol: str = "BTCUSDT"
) -> DataFrame:
    """``date, close`` CSV as a daily series of one symbol."""
    header = spark.read.option("header", "true").csv(path).columns
    missing = sorted({"date", "close"} - set(header))
    if missing:
        raise ValueError(f"missing columns {missing}; found {header}")
    types = {f.name: f.dataType for f in CLOSE_SCHEMA.fields}
    schema = T.StructType([T.StructField(n, types.get(n, T.StringType())) for n in header])
    df = spark.read.schema(schema).option("header", "true").csv(path)
    return df.select(F.lit(symbol).alias("symbol"), F.col("date").alias("ds"), "close")
