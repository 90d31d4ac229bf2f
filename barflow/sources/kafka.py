"""Kafka-shaped input: reading one local day of a topic, and the message envelope."""

from __future__ import annotations

import json
from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barflow.constants import LOCAL_ZONE
from barflow.functions.timecols import local_day_bounds_ms, timestamp_from_ms, zone_date
from barflow.schemas import ENVELOPE_SCHEMA

ENVELOPE_COLUMNS = tuple(ENVELOPE_SCHEMA.fieldNames())


def security_options(
    username: str,
    password: str,
    protocol: str = "SASL_SSL",
    mechanism: str = "PLAIN",
    endpoint_algorithm: str = "https",
    request_timeout_ms: int = 60000,
    session_timeout_ms: int = 45000,
) -> dict[str, str]:
    """Source options for a broker that asks for a user and a password."""
    login = (
        "org.apache.kafka.common.security.plain.PlainLoginModule required "
        f"username={json.dumps(username)} password={json.dumps(password)};"
    )
    return {
        "kafka.security.protocol": protocol,
        "kafka.sasl.mechanism": mechanism,
        "kafka.sasl.jaas.config": login,
        "kafka.ssl.endpoint.identification.algorithm": endpoint_algorithm,
        "kafka.request.timeout.ms": str(request_timeout_ms),
        "kafka.session.timeout.ms": str(session_timeout_ms),
    }


def kafka_day_options(
    bootstrap: str,
    topic: str,
    day: str | date,
    zone: str = LOCAL_ZONE,
    security: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options for a bounded read of one local day.

    The source looks the offsets up itself, per partition. A partition without a message after
    the start is read from its end, so it contributes nothing instead of being scanned in full.
    """
    start, end = local_day_bounds_ms(day, zone)
    return {
        "kafka.bootstrap.servers": bootstrap,
        "subscribe": topic,
        "startingTimestamp": str(start),
        "endingTimestamp": str(end),
        "startingOffsetsByTimestampStrategy": "latest",
        "failOnDataLoss": "false",
        **(security or {}),
    }


def kafka_day_scan(spark: SparkSession, day: str | date, zone: str = LOCAL_ZONE, **options) -> DataFrame:
    """One local day of a topic; ``options`` are those of ``kafka_day_options``."""
    df = spark.read.format("kafka").options(**kafka_day_options(day=day, zone=zone, **options)).load()
    return kafka_envelope_day(df, day, zone)


def kafka_stream_scan(spark: SparkSession, bootstrap: str, topic: str, **options) -> DataFrame:
    """The same topic as an unbounded stream of envelopes."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", bootstrap)
    return envelope_project(reader.option("subscribe", topic).options(**options).load())


def envelope_project(df: DataFrame, zone: str = LOCAL_ZONE) -> DataFrame:
    """Envelope columns with text key and value and the message's date in ``zone``."""
    text = {name: F.col(name).cast("string") for name in ("key", "value")}
    return df.withColumns(text).select(
        *ENVELOPE_COLUMNS, zone_date(F.col("timestamp"), zone).alias("date")
    )


def kafka_envelope_day(df: DataFrame, day: str | date, zone: str = LOCAL_ZONE) -> DataFrame:
    """Envelopes of one local day, as a range on ``timestamp`` that the scan can use."""
    start, end = local_day_bounds_ms(day, zone)
    at = F.col("timestamp")
    inside = df.where(
        (at >= timestamp_from_ms(F.lit(start))) & (at < timestamp_from_ms(F.lit(end)))
    )
    return envelope_project(inside, zone)


def offsets_by_time(df: DataFrame, day: str | date, zone: str = LOCAL_ZONE) -> DataFrame:
    """Start and end offset per topic and partition for one local day, from envelopes.

    A bound without a later message is the end of the partition; the end is never before the
    start.
    """
    start, end = local_day_bounds_ms(day, zone)
    at, offset = F.unix_millis("timestamp"), F.col("offset")

    def first_from(bound: int):
        return F.coalesce(F.min(F.when(at >= bound, offset)), F.max(offset) + 1)

    found = df.groupBy("topic", "partition").agg(
        first_from(start).alias("start_offset"), first_from(end).alias("_end")
    )
    return found.select(
        "topic",
        "partition",
        "start_offset",
        F.greatest("_end", "start_offset").alias("end_offset"),
    )
