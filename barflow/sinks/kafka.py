"""Messages for a topic: key and JSON value."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.constants import MESSAGE_KEY_FALLBACK


def kafka_encode(df: DataFrame) -> DataFrame:
    """Key: the symbol, else the event type, else a constant. Value: the row as JSON."""
    choices = [
        F.nullif(F.col(name).cast("string"), F.lit(""))
        for name in ("symbol", "event_type")
        if name in df.columns
    ]
    key = F.coalesce(*choices, F.lit(MESSAGE_KEY_FALLBACK))
    value = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    return df.select(key.alias("key"), value.alias("value"))


def write_kafka(
    df: DataFrame, bootstrap: str, topic: str, options: Mapping[str, str] | None = None
) -> None:
    """Publish rows; delivery is acknowledged by all replicas."""
    (
        kafka_encode(df)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap)
        .option("kafka.acks", "all")
        .option("topic", topic)
        .options(**(options or {}))
        .save()
    )


def write_kafka_stream(
    df: DataFrame,
    bootstrap: str,
    topic: str,
    checkpoint: str,
    options: Mapping[str, str] | None = None,
):
    """Publish a stream of rows."""
    return (
        kafka_encode(df)
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap)
        .option("kafka.acks", "all")
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .options(**(options or {}))
        .start()
    )
