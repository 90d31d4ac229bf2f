"""Partitioned file sinks.

Writers overwrite the partitions they touch (dynamic mode), so a re-run leaves the table
unchanged; ``mode="append"`` adds instead. Loads that may hold part of a partition use
``mode="merge"``: rows that are there stay unless a new row has their key, so neither a re-run nor a
load of the other half loses or repeats rows. Rows are rebalanced on the partition columns first:
small partitions share a task and a partition holding much of the data is split over several.
Each writer returns the number of rows it wrote, observed during the write.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.functions.checks import require_columns
from barflow.operators.bars import observed, sort_for_files
from barflow.operators.klines import with_month, with_month_key
from barflow.schemas import BAR_COLUMNS, SCORED_POST_SCHEMA
from barflow.session import drop_path, path_exists, scratch_path
from barflow.sources.files import bar_csv_scan, check_format, event_csv_scan, scored_post_scan, silver_scan

RECORDS_PER_FILE = 5_000_000


def write_partitioned(
    df: DataFrame,
    path: str,
    by: Sequence[str],
    fmt: str = "parquet",
    mode: str = "overwrite",
    rebalance: bool = True,
    **options,
) -> int:
    """Write ``df`` below ``path`` with one directory level per column of ``by``."""
    if rebalance:
        df = df.hint("rebalance", *by)
    counted, seen = observed(df)
    (
        counted.write.mode(mode)
        .format(fmt)
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", RECORDS_PER_FILE)
        .options(**options)
        .partitionBy(*by)
        .save(path)
    )
    return seen.get["rows"]


def plain_mode(mode: str) -> str:
    """A merge ends in an overwrite of the touched partitions."""
    return "overwrite" if mode == "merge" else mode


def merge_partitioned(
    df: DataFrame, path: str, by: Sequence[str], keys: Sequence[str], scan: Callable[[], DataFrame],
    write: Callable[[DataFrame], int],
) -> int:
    """New rows together with the rows of the partitions they touch, except those with their keys.

    Only touched partitions are read and written. The union is written to the shared folder first:
    a table cannot be read and overwritten at once, and a failure leaves the old partitions whole.
    Returns the number of new rows.
    """
    spark = df.sparkSession
    if not path_exists(spark, path):
        return write(df)
    load, whole = scratch_path(spark, "load"), scratch_path(spark, "merged")
    df.write.parquet(load)
    new = spark.read.schema(df.schema).parquet(load)
    if not new.where(reduce(or_, [F.col(c).isNull() for c in by])).isEmpty():
        raise ValueError(f"rows without a value in {list(by)} have no partition to be merged into")
    touched = new.select(*by).distinct()
    old = scan().join(touched, list(by), "left_semi").select(*df.columns)
    old, fresh = old.alias("old"), new.select(*keys).distinct().alias("new")
    same = reduce(and_, [F.col(f"old.{k}").eqNullSafe(F.col(f"new.{k}")) for k in keys])
    new.unionByName(old.join(fresh, same, "left_anti")).write.parquet(whole)
    write(spark.read.schema(df.schema).parquet(whole))
    rows = new.count()
    drop_path(spark, load)
    drop_path(spark, whole)
    return rows


def write_raw(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> int:
    """Envelopes into ``topic=…/date=…``, as parquet or JSON."""
    return write_partitioned(df, path, ("topic", "date"), check_format(fmt), mode)


def write_gold(df: DataFrame, path: str, mode: str = "overwrite") -> int:
    """Daily candles into ``day=…/symbol=…``."""
    return write_partitioned(df, path, ("day", "symbol"), "parquet", mode, compression="snappy")


def write_silver(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> int:
    """Validated bars into ``symbol=…/year=…/month=…``; ``fmt="csv"`` writes headered CSV.

    With an ``interval`` column the folders lie below ``interval=…``, and bars of several widths keep apart.
    """
    options = {"header": "true"} if fmt == "csv" else {}
    width = ("interval",) if "interval" in df.columns else ()
    by, dated = (*width, "symbol", "year", "month"), with_month(df)

    def write(rows: DataFrame) -> int:
        return write_partitioned(rows, path, by, fmt, plain_mode(mode), compression="snappy", **options)

    if mode != "merge":
        return write(dated)
    keys = (*width, "symbol", "open_ts")
    return merge_partitioned(dated, path, by, keys, lambda: silver_scan(df.sparkSession, path, fmt, bool(width)), write)


def write_month(df: DataFrame, path: str, mode: str = "overwrite") -> int:
    """Bars as headered CSV into ``interval=…/symbol=…/month=…``, sorted by time.

    All symbols and months are written by one job. The files of a month cover ascending,
    disjoint ranges of ``ts``; a month is one file unless it is too large for one task.
    """
    by = ("interval", "symbol", "month")
    require_columns(df, BAR_COLUMNS)
    months = with_month_key(df.select(*BAR_COLUMNS))

    def write(rows: DataFrame) -> int:
        ordered = sort_for_files(rows, by, ("ts",))
        return write_partitioned(ordered, path, by, "csv", plain_mode(mode), rebalance=False, header="true")

    if mode != "merge":
        return write(months)
    layout = "interval STRING, symbol STRING, month STRING"
    keys = ("interval", "symbol", "ts")
    return merge_partitioned(months, path, by, keys, lambda: bar_csv_scan(df.sparkSession, path, layout), write)


def write_forecast(df: DataFrame, path: str, mode: str = "overwrite") -> int:
    """Forecasts as headered CSV into ``ds=…/symbol=…``."""
    return write_partitioned(
        df, path, ("ds", "symbol"), "csv", mode, header="true", compression="none"
    )


def write_events(df: DataFrame, path: str, mode: str = "overwrite") -> int:
    """Macro events as headered CSV, partitioned by source, type, year and month."""
    by = ("source", "event_type", "event_year", "event_month")

    def write(rows: DataFrame) -> int:
        return write_partitioned(rows, path, by, "csv", plain_mode(mode), header="true", escape='"')

    if mode != "merge":
        return write(df)
    keys = ("source", "event_type", "event_date", "event_name", "event_time_utc")
    sentiment = "event_sentiment" in df.columns
    return merge_partitioned(df, path, by, keys, lambda: event_csv_scan(df.sparkSession, path, sentiment=sentiment), write)


def write_posts(df: DataFrame, path: str, mode: str = "overwrite") -> int:
    """Scored posts as quoted, headered CSV, partitioned by date."""
    columns = SCORED_POST_SCHEMA.fieldNames()
    posts, by = require_columns(df, columns).select(*columns), ("event_date",)

    def write(rows: DataFrame) -> int:
        return write_partitioned(rows, path, by, "csv", plain_mode(mode), header="true", quoteAll="true", escape='"')

    if mode != "merge":
        return write(posts)
    keys = ("event_date", "created_at", "truth_id", "raw_text")
    return merge_partitioned(posts, path, by, keys, lambda: scored_post_scan(df.sparkSession, path), write)


def csv_append(df: DataFrame, path: str, columns: Sequence[str]) -> int:
    """Append the given columns as headered CSV and ignore the others."""
    counted, seen = observed(require_columns(df, columns).select(*columns))
    counted.write.mode("append").option("header", "true").csv(path)
    return seen.get["rows"]


def rows_per_partition(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Row count report of a table by its partition columns."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"))
