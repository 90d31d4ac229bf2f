"""Structured Streaming forms of the raw copy, the roll-up and the deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from barflow.constants import LOCAL_ZONE
from barflow.functions.timecols import interval_ms, timestamp_from_ms
from barflow.operators.bars import candle_aggregates
from barflow.operators.klines import VALUE_COLUMNS
from barflow.sources.files import check_format
from barflow.sources.kafka import envelope_project


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", **options
) -> DataFrame:
    """Files below ``path`` as a stream with an explicit schema."""
    return spark.readStream.schema(schema).format(fmt).options(**options).load(path)


def start_files(
    df: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
    available_now: bool = True,
    trigger: str = "1 minute",
) -> StreamingQuery:
    """Append a stream to files, exactly once per checkpoint.

    ``available_now`` processes what is there and stops, which makes it the daily batch.
    """
    writer = (
        df.writeStream.outputMode("append")
        .format(fmt)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=trigger)
    return writer.start()


def stream_raw(
    envelopes: DataFrame,
    path: str,
    checkpoint: str,
    zone: str = LOCAL_ZONE,
    fmt: str = "parquet",
    **options,
) -> StreamingQuery:
    """Copy a topic into the raw lake, partitioned by topic and local date."""
    return start_files(
        envelope_project(envelopes, zone), path, checkpoint, ("topic", "date"), check_format(fmt), **options
    )


def with_event_time(df: DataFrame, delay: str | None) -> DataFrame:
    """Event time from ``ts`` with a watermark; rows later than ``delay`` may be dropped.

    Without a delay the frame has its event time already, from the step before.
    """
    if delay is None:
        return df
    return df.withColumn("event_time", timestamp_from_ms(F.col("ts"))).withWatermark(
        "event_time", delay
    )


def stream_bars(
    df: DataFrame, interval: str, delay: str | None = "10 minutes", order: Sequence[str] = ("ts",)
) -> DataFrame:
    """Tumbling bars per symbol, aligned to the epoch.

    Bars that are emitted again while they are open must go through ``stream_latest`` first, which
    hands on its event time (``delay=None``). In append mode a bar appears once the watermark has passed its end, so open bars are never
    emitted twice.
    """
    width = f"{interval_ms(interval) // 1000} seconds"
    return (
        with_event_time(df, delay)
        .groupBy("symbol", F.window("event_time", width))
        .agg(*candle_aggregates(order))
        .select(
            F.unix_millis(F.col("window.start")).alias("ts"),
            "symbol",
            F.lit(interval).alias("interval"),
            *VALUE_COLUMNS,
            "rows",
        )
    )


def stream_latest(
    df: DataFrame, latest: Sequence[str], delay: str = "10 minutes", keys: Sequence[str] = ("symbol", "ts")
) -> DataFrame:
    """The last arrival of every key, by the columns ``latest``, once the watermark has passed it.

    A bar that is emitted again and again while it is open appears once, with its final values.
    ``event_time`` stays, so that a windowed step can follow.
    """
    others = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*others), F.struct(*latest)).alias("_best")
    return (
        with_event_time(df, delay)
        .groupBy(*keys, "event_time")
        .agg(best)
        .select(*[c if c in keys else f"_best.{c}" for c in df.columns], "event_time")
    )


def stream_dedup(
    df: DataFrame, delay: str = "10 minutes", keys: Sequence[str] = ("symbol", "ts")
) -> DataFrame:
    """Drop repeats of a key while the watermark still covers it; state stays bounded.

    The first arrival stays, at once: right where repeats are equal. See ``stream_latest``.
    """
    return with_event_time(df, delay).dropDuplicatesWithinWatermark(list(keys)).drop("event_time")
