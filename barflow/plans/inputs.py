"""The generic tables seen as market data, and the same views in SQL.

events     → ticks, bars, message envelopes (symbol = event type)
orders     → daily closes (symbol = priority) and monthly releases (type = status)
documents  → posts;  labels → class probabilities
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barflow.functions.once import with_computed
from barflow.functions.timecols import iso_from_ms
from barflow.operators.bars import daily_close, ticks_as_bars
from barflow.operators.klines import decode_payload
from barflow.operators.macro import decision_class
from barflow.operators.returns import log_returns
from barflow.session import pin_settings


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return pin_settings(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def text_dates(df: DataFrame, *columns: str) -> DataFrame:
    """Dates as ISO text, which every engine prints alike."""
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in columns})


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


# --- ticks and bars ---------------------------------------------------------


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_ticks(table(spark, sf_dir, "events"))


def as_ticks(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_type").alias("symbol"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ts"),
        "event_id",
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("double").alias("volume"),
    )


TICKS = """ticks AS (
  SELECT event_type AS symbol, epoch_us(ts) // 1000 AS ts, event_id, value AS price,
         CAST(json_extract(props, '$.k') AS DOUBLE) AS volume
  FROM events)"""


def tick_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ticks_as_bars(ticks(spark, sf_dir))


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_bars(ticks(spark, sf_dir))


def as_bars(t: DataFrame) -> DataFrame:
    """Bars with a spread around the tick; small prices break the positive-price rule."""
    k, price = F.col("volume"), F.col("price")
    once = with_computed(t.withColumnRenamed("volume", "_k"), {"volume": F.col("_k")})
    return once.select(
        "event_id",
        "ts",
        iso_from_ms(F.col("ts")).alias("iso_ts"),
        "symbol",
        F.lit("1m").alias("interval"),
        price.alias("open"),
        (price + k / 100).alias("high"),
        (price - k / 100).alias("low"),
        (price + (F.pmod(k, F.lit(7.0)) - 3) / 10).alias("close"),
        "volume",
    )


_ISO_SQL = """strftime(make_timestamp(ts * 1000), '%Y-%m-%dT%H:%M:%S')
         || CASE WHEN ts % 1000 <> 0 THEN strftime(make_timestamp(ts * 1000), '.%f') ELSE '' END"""

BARS = f"""{TICKS}, bars AS (
  SELECT event_id, ts, {_ISO_SQL} || 'Z' AS iso_ts, symbol, '1m' AS interval,
         price AS open, price + volume / 100 AS high, price - volume / 100 AS low,
         price + (fmod(volume, 7.0) - 3) / 10 AS close, volume
  FROM ticks)"""


def minute_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars whose time is cut to the minute, so that keys repeat like a re-emitted open bar."""
    b = bars(spark, sf_dir)
    return b.withColumn("ts", F.col("ts") - F.pmod("ts", F.lit(60000)))


MINUTE_BARS = f"""{BARS}, minute_bars AS (
  SELECT * REPLACE (ts - ts % 60000 AS ts) FROM bars)"""


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_envelopes(bars(spark, sf_dir))


def as_envelopes(b: DataFrame) -> DataFrame:
    """Messages as a broker hands them out: JSON for even ids, CSV for odd ones."""
    fields = ["ts", "iso_ts", "symbol", "interval", "open", "high", "low", "close", "volume"]
    as_json = F.to_json(F.struct(*fields))
    as_csv = F.to_csv(F.struct(*fields))
    even = F.col("event_id") % 2 == 0
    return b.select(
        F.lit("topic_0").alias("topic"),
        (F.col("event_id") % 3).cast("int").alias("partition"),
        F.expr("event_id div 3").alias("offset"),
        F.timestamp_millis("ts").alias("timestamp"),
        F.lit(0).alias("timestampType"),
        F.col("symbol").alias("key"),
        F.when(even, as_json).otherwise(as_csv).alias("value"),
    )


def with_payload(df: DataFrame, *keep: str) -> DataFrame:
    """Envelopes with what their message says: topic, broker time, form, and the decoded fields of the value."""
    shown = df.withColumns({
        "partition": F.col("partition").cast("bigint"),
        "sent": F.unix_millis("timestamp"),
        "form": F.when(F.startswith("value", F.lit("{")), "json").otherwise("csv"),
    })
    return decode_payload(shown, keep=(*keep, "topic", "sent", "form"))


PAYLOAD_SQL = """'topic_0' AS topic, ts AS sent,
       CASE event_id % 2 WHEN 0 THEN 'json' ELSE 'csv' END AS form,
       ts, iso_ts, symbol, interval, open, high, low, close, volume"""


# --- daily series -----------------------------------------------------------


def closes(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("symbol"),
        F.col("o_orderdate").cast("date").alias("day"),
        F.col("o_totalprice").alias("close"),
        "o_orderkey",
    )
    return daily_close(orders, F.col("day"), ("o_orderkey",))


CLOSES = """closes AS (
  SELECT o_orderpriority AS symbol, CAST(o_orderdate AS DATE) AS ds,
         arg_max(o_totalprice, o_orderkey) AS close
  FROM orders GROUP BY ALL)"""


def returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_returns(closes(spark, sf_dir))


RETURNS = f"""{CLOSES}, ratios AS (
  SELECT symbol, ds, close / lag(close) OVER (PARTITION BY symbol ORDER BY ds) AS ratio
  FROM closes), returns AS (
  SELECT symbol, ds, ln(ratio) AS ret FROM ratios WHERE ratio > 0)"""


# --- events -----------------------------------------------------------------


def releases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly figures per order status, nested like published macro releases."""
    step = 5000.0
    monthly = (
        table(spark, sf_dir, "orders")
        .groupBy("o_orderstatus", F.trunc("o_orderdate", "MM").alias("month"))
        .agg(
            F.avg("o_totalprice").alias("average"),
            ((F.min("o_totalprice") + F.max("o_totalprice")) / 2).alias("middle"),
            F.min("o_orderdate").cast("date").alias("first_day"),
            F.count(F.lit(1)).alias("n"),
        )
    )
    by_status = Window.partitionBy("o_orderstatus").orderBy("month")
    level = F.floor(F.col("average") / step) * step
    day = F.date_format("first_day", "yyyy-MM-dd")
    return monthly.withColumns(
        {"level": level, "previous": F.lag(level).over(by_status)}
    ).select(
        F.lit("manual_macro").alias("source"),
        F.concat(F.lit("status_"), F.lower("o_orderstatus")).alias("event_type"),
        F.lit("Monthly average").alias("event_name"),
        day.alias("event_date"),
        F.concat(day, F.lit("T14:00:00Z")).alias("event_time_utc"),
        F.when(F.col("n") % 7 != 0, F.col("level")).cast("double").alias("actual"),
        (F.floor(F.col("middle") / step) * step).cast("double").alias("forecast"),
        F.col("previous").cast("double").alias("previous"),
        F.lit("usd").alias("units"),
        F.struct(
            F.lit("14:00").alias("local_time_str"),
            F.date_format("month", "yyyy-MM").alias("period_month"),
        ).alias("extra"),
    )


RELEASES = """monthly AS (
  SELECT o_orderstatus AS status, date_trunc('month', o_orderdate) AS month,
         floor(avg(o_totalprice) / 5000) * 5000 AS level,
         floor((min(o_totalprice) + max(o_totalprice)) / 2 / 5000) * 5000 AS forecast,
         CAST(min(o_orderdate) AS DATE) AS event_date, count(*) AS n
  FROM orders GROUP BY ALL), releases AS (
  SELECT 'manual_macro' AS source, 'status_' || lower(status) AS event_type,
         'Monthly average' AS event_name, event_date,
         strftime(event_date, '%Y-%m-%d') || 'T14:00:00Z' AS event_time_utc,
         CASE WHEN n % 7 <> 0 THEN level END AS actual, forecast,
         lag(level) OVER (PARTITION BY status ORDER BY month) AS previous,
         'usd' AS units, '14:00' AS local_time_str, strftime(month, '%Y-%m') AS period_month
  FROM monthly)"""


def decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decision_class(releases(spark, sf_dir)).select(
        "event_type", "event_date", "rate", "previous", "delta", "decision_class"
    )


DECISIONS = f"""{RELEASES}, decisions AS (
  SELECT event_type, event_date, coalesce(actual, forecast) AS rate, previous,
         coalesce(actual, forecast) - previous AS delta,
         CASE WHEN coalesce(actual, forecast) > previous THEN 'hike'
              WHEN coalesce(actual, forecast) < previous THEN 'cut'
              WHEN coalesce(actual, forecast) = previous THEN 'hold'
              ELSE 'unknown' END AS decision_class
  FROM releases)"""


# --- posts ------------------------------------------------------------------


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_add(F.lit("2025-01-01").cast("date"), (F.col("doc_id") % 60).cast("int"))
    zone = (
        F.when(F.col("doc_id") % 3 == 0, "Z")
        .when(F.col("doc_id") % 3 == 1, "+00:00")
        .otherwise("-05:00")
    )
    date = F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T22:30:00"), zone)
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("post_id"), date.alias("date"), "text"
    )


POSTS = """posts AS (
  SELECT doc_id AS post_id,
         strftime(DATE '2025-01-01' + CAST(doc_id % 60 AS INTEGER), '%Y-%m-%d') || 'T22:30:00'
         || CASE doc_id % 3 WHEN 0 THEN 'Z' WHEN 1 THEN '+00:00' ELSE '-05:00' END AS date,
         text
  FROM documents)"""
