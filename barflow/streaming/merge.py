"""Corrections in streams: bars that are revised at any time, merged into a table batch by batch.

A watermark bounds state by dropping what comes after it. Here the table itself is the state: each
batch reads the months it touches, keeps the greatest revision of every bar and overwrites them. So a
correction may come years later, batches may come in any order, and replays change nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from barflow.operators.klines import dedup_rows, validate_bars, with_month
from barflow.session import drop_path, mark_path, path_exists
from barflow.sinks.files import write_partitioned
from barflow.sources.files import silver_scan

REVISION = "revision"
KEYS = ("symbol", "open_ts")
PARTITIONS = ("symbol", "year", "month")


def revised_bars(df: DataFrame, revision: str = REVISION) -> DataFrame:
    """Valid bars in the silver layout, of each the one with the greatest ``revision``.

    Invalid bars revise nothing. A null revision is less than any other; equal ones are settled by the values.
    """
    numbered = df.select("symbol", "ts", "open", "high", "low", "close", "volume", F.col(revision).cast("bigint").alias(REVISION))
    return _newest(with_month(validate_bars(numbered, dedup=False, by=(REVISION,))))


def _newest(df: DataFrame) -> DataFrame:
    return dedup_rows(df, [*KEYS, "date", "year", "month"], (REVISION,))


def revised_scan(spark: SparkSession, path: str) -> DataFrame:
    """The table that ``merge_batch`` keeps: silver bars with their revision. ``silver_scan`` reads it too."""
    columns = silver_scan(spark, path).schema.fields
    return spark.read.schema(T.StructType([*columns, T.StructField(REVISION, T.LongType())])).parquet(path)


def merge_batch(batch: DataFrame, batch_id: int, path: str, log: str, revision: str = REVISION) -> None:
    """Merge one batch of revised bars into the table at ``path``; the same batch twice counts once.

    The merged months are written below ``log`` first. A failure before that leaves the table as it was; one
    later, even in the middle of the overwrite, is made good from there when the batch is tried again.
    """
    spark = batch.sparkSession
    done, work = f"{log}/done/{batch_id}", f"{log}/batch-{batch_id}"
    if path_exists(spark, done):
        return
    load, merged, ready = f"{work}/load", f"{work}/merged", f"{work}/ready"
    if not path_exists(spark, ready):
        new = revised_bars(batch, revision)
        new.write.mode("overwrite").parquet(load)
        whole = new = spark.read.schema(new.schema).parquet(load)
        if path_exists(spark, path):
            touched = new.select(*PARTITIONS).distinct()
            old = revised_scan(spark, path).join(touched, list(PARTITIONS), "left_semi")
            whole = _newest(new.unionByName(old.select(*new.columns)))
        whole.write.mode("overwrite").parquet(merged)
        mark_path(spark, ready)
    whole = spark.read.parquet(merged)
    if not whole.isEmpty():
        write_partitioned(whole, path, PARTITIONS, compression="snappy")
    mark_path(spark, done)
    # only the last batch of a stream is ever tried again
    drop_path(spark, f"{log}/done/{batch_id - 1}")
    drop_path(spark, work)


def start_merge(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    revision: str = REVISION,
    available_now: bool = True,
    trigger: str = "1 minute",
) -> StreamingQuery:
    """Keep the table at ``path`` at the latest revision of every bar of ``stream``.

    One stream writes a table at a time: two at once could overwrite each other's months. A new checkpoint reads the
    source again and ends in the same table.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        merge_batch(batch, batch_id, path, f"{checkpoint}/merges", revision)

    writer = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=trigger)
    return writer.start()
