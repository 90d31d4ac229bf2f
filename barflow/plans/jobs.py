"""End-to-end jobs: a source, the operators, a sink. Each returns the rows it wrote."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barflow.constants import LOCAL_ZONE
from barflow.functions.timecols import as_date
from barflow.operators.bars import bars_daily, daily_close_from_text
from barflow.operators.forecast import (
    Fitter,
    forecast_errors,
    forecast_next_day,
    forecast_period,
)
from barflow.operators.klines import (
    bars_in_range,
    decode_payload,
    local_day_filter,
    symbol_filter,
    validate_bars,
)
from barflow.operators.macro import flatten_macro, sentiment_events
from barflow.operators.posts import (
    chunk_tokens,
    economic_posts,
    pool_sentiment,
    post_record,
    posts_since,
    score_chunks,
)
from barflow.session import spread
from barflow.sinks.files import (
    write_events,
    write_forecast,
    write_gold,
    write_month,
    write_posts,
    write_raw,
    write_silver,
)
from barflow.sources.archive import archive_files, load_archives
from barflow.sources.files import (
    bar_csv_scan,
    daily_csv_scan,
    event_csv_scan,
    macro_jsonl_scan,
    post_jsonl_scan,
    raw_day_scan,
)
from barflow.sources.kafka import kafka_envelope_day

MONTH_PARTITIONS = "interval STRING, symbol STRING, month STRING"


def raw_day_job(
    envelopes: DataFrame, raw_base: str, day: str | date, zone: str = LOCAL_ZONE, fmt: str = "parquet"
) -> int:
    """One local day of envelopes into the raw lake."""
    return write_raw(kafka_envelope_day(envelopes, day, zone), raw_base, fmt)


def gold_day_bars(
    spark: SparkSession,
    raw_base: str,
    day: str | date,
    topic: str | None = None,
    zone: str = LOCAL_ZONE,
    fmt: str = "parquet",
    dedup: bool = True,
) -> DataFrame:
    """Candles of one local day from the raw lake; the last arrival of a repeated bar counts."""
    raw = raw_day_scan(spark, raw_base, day, topic, fmt)
    bars = decode_payload(raw, keep=("timestamp", "topic", "partition", "offset"))
    arrival = ("timestamp", "topic", "partition", "offset")
    return bars_daily(
        local_day_filter(bars, day, zone),
        zone,
        dedup,
        latest=arrival,
        order=("ts",) if dedup else ("ts", *arrival),
    )


def gold_day_job(spark: SparkSession, raw_base: str, gold_root: str, day: str | date, **options) -> int:
    """Daily candles of one local day into the gold table."""
    return write_gold(gold_day_bars(spark, raw_base, day, **options), gold_root)


def archive_backfill_job(
    spark: SparkSession,
    archive_base: str,
    raw_base: str,
    start: str | date,
    end: str | date,
    mode: str = "merge",
    report: str | None = None,
) -> int:
    """Archived bars of [start, end] into monthly CSV, every symbol and month in one job.

    Every archive is read once. ``report`` names a folder for what was not loaded: JSON lines of
    ``path, reason`` below ``faults`` and of ``path, line_no, reason`` below ``rejects``, of this run. Without it
    faulty archives raise a warning that counts them.
    """
    load = load_archives(archive_files(spark, archive_base))
    try:
        rows = write_month(bars_in_range(load.bars, start, end), raw_base, mode)
        if report is not None:
            load.faults.write.mode("overwrite").json(f"{report}/faults")
            load.rejects.write.mode("overwrite").json(f"{report}/rejects")
        elif faulty := load.faults.count():
            warnings.warn(f"{faulty} archives below {archive_base} were not loaded", stacklevel=2)
    finally:
        load.drop()
    return rows


def silver_job(
    spark: SparkSession,
    raw_base: str,
    silver_base: str,
    start: str | date,
    end: str | date,
    symbols: Iterable[str] | None = None,
    fmt: str = "parquet",
    mode: str = "merge",
    *,
    interval: str,
) -> int:
    """Monthly CSV bars of one width and [start, end] to validated bars.

    The width and the months prune directories; symbols and months are not looped over. Of repeated
    bars the one with the greatest volume counts: a bar that is emitted again while open only grows.
    The rest of a month that an earlier run loaded stays.
    """
    first, last = as_date(start), as_date(end)
    if last < first:
        raise ValueError("end must not be before start")
    bars = bar_csv_scan(spark, raw_base, MONTH_PARTITIONS)
    bars = bars.where(F.col("interval") == interval)
    bars = bars.where(F.col("month").between(first.strftime("%Y-%m"), last.strftime("%Y-%m")))
    if symbols is not None:
        bars = symbol_filter(bars, symbols)
    valid = validate_bars(bars_in_range(bars, first, last), latest=("volume", "close"), by=("interval",))
    return write_silver(valid, silver_base, fmt, mode)


def forecast_job(
    spark: SparkSession,
    daily_path: str | Sequence[str],
    out: str,
    start: str | date | None = None,
    end: str | date | None = None,
    fitter: Fitter | None = None,
) -> int:
    """Forecasts from daily CSV bars, with errors when a period is given."""
    closes = daily_close_from_text(daily_csv_scan(spark, daily_path))
    if start is not None and end is not None:
        forecasts = forecast_errors(forecast_period(closes, start, end, fitter), closes)
    else:
        forecasts = forecast_next_day(closes, fitter)
    return write_forecast(forecasts.withColumn("created_at", F.current_timestamp()), out)


def macro_job(spark: SparkSession, jsonl: str, event_base: str, mode: str = "merge") -> int:
    """Nested macro releases into the flat event lake; other events of the months stay."""
    return write_events(flatten_macro(macro_jsonl_scan(spark, jsonl)), event_base, mode)


def macro_sentiment_job(spark: SparkSession, event_base: str, source: str = "manual_macro", mode: str = "merge") -> int:
    """Sentiment rows of one source, back into the event lake under their own source."""
    return write_events(sentiment_events(event_csv_scan(spark, event_base, source)), event_base, mode)


def scored_posts(posts: DataFrame, model: Callable[[Column], Column], **record) -> DataFrame:
    """Economic posts scored by ``model``, as 16-column events; an ``id`` column becomes their ``truth_id``."""
    kept = economic_posts(posts_since(posts if "id" in posts.columns else posts.withColumn("id", F.lit(None).cast("string"))))
    facts = ["text", "created_at", "is_economic", "economic_categories", "ids"]
    # Equal posts share a key, and their ids are collected; they are scored once and given back as often as they came; all
    # else follows from date and text. Scoring is costly per byte, so the few rows left are spread by
    # number, not by size; the pooling uses the same partitioning. The post itself travels with its
    # first chunk, so the source is read once and nothing is joined.
    distinct = kept.groupBy("date", *facts[:-1]).agg(F.collect_list(F.struct("id")).alias("ids"))
    named = distinct.withColumn("post_id", F.sha2(F.concat_ws("\x1f", "date", "text"), 256))
    chunks = chunk_tokens(spread(named.drop("date"), "post_id"), keep=("post_id", *facts))
    once = chunks.withColumns({c: F.when(F.col("chunk") == 0, F.col(c)) for c in facts})
    scored = pool_sentiment(score_chunks(once, model), carry=facts)
    every = scored.select("*", F.explode("ids").alias("_one")).withColumn("truth_id", F.col("_one.id"))
    return post_record(every, **record)


def posts_job(spark: SparkSession, jsonl: str, out: str, model: Callable[[Column], Column], mode: str = "merge") -> int:
    """Posts from JSON lines, filtered, scored and written as events; other posts of the dates stay.

    Of posts with an ``id``, equal ones of several loads all stay. Without one, a post that equals one of an
    earlier load counts as that one loaded again.
    """
    return write_posts(scored_posts(post_jsonl_scan(spark, jsonl), model), out, mode)
