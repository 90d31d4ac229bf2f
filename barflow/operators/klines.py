"""Decoding, parsing and validating bars."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barflow.constants import (
    FEED_SOURCE,
    KLINE_EVENT_TYPE,
    LOCAL_ZONE,
    MAX_OPEN_TIME_MS,
    MICROSECOND_FLOOR,
    MIN_OPEN_TIME_MS,
    TICKER_EVENT_TYPE,
)
from barflow.functions.checks import require_columns
from barflow.functions.once import with_computed
from barflow.functions.timecols import (
    as_date,
    iso_from_ms,
    local_day,
    local_day_bounds_ms,
    month_key,
    timestamp_from_ms,
    utc_range_ms,
    zoneless_stamp,
)
from barflow.schemas import BAR_DDL, BAR_SCHEMA

PRICE_COLUMNS = ("open", "high", "low", "close")
VALUE_COLUMNS = (*PRICE_COLUMNS, "volume")

# Text accepted as a number: digits, optional point and exponent. NaN, infinities and
# the type suffixes a JVM parser would take are rejected.
NUMBER_TEXT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def decode_payload(df: DataFrame, value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Nine typed bar fields from a JSON object or one CSV line per row.

    The decoder is chosen for the row as a whole, so one row never mixes fields of both.
    Rows that are neither give nulls; ``validate_bars`` drops them.
    """
    text = F.col(value).cast("string")
    csv_options = {"header": "false", "sep": ",", "quote": '"', "escape": "\\"}
    decoded = F.when(
        F.startswith(F.ltrim(text, F.lit(" \t\r\n")), F.lit("{")), F.from_json(text, BAR_SCHEMA)
    ).otherwise(F.from_csv(text, BAR_DDL, csv_options))
    # Unpacking through a generator keeps later filters from decoding the text again.
    return df.select(*keep, F.inline_outer(F.array(decoded)))


def local_day_filter(df: DataFrame, day: str | date, zone: str = LOCAL_ZONE) -> DataFrame:
    """Rows of one local calendar day, as a range on ``ts``; it reaches the scan where ``ts`` is stored."""
    start, end = local_day_bounds_ms(day, zone)
    return df.where((F.col("ts") >= start) & (F.col("ts") < end))


def with_local_day(df: DataFrame, zone: str = LOCAL_ZONE, name: str = "day") -> DataFrame:
    return df.withColumn(name, local_day(F.col("ts"), zone))


def _number(column: str) -> Column:
    text = F.col(column).cast("string")
    return F.when(F.rlike(text, F.lit(NUMBER_TEXT)), F.trim(text).try_cast("double"))


def _parsed_kline(df: DataFrame) -> DataFrame:
    """Text fields as numbers next to the input, and why a row is unreadable."""
    raw = F.trim(F.col("open_time").cast("string")).try_cast("bigint")
    numbers = {"_raw_ts": raw, **{f"_{name}": _number(name) for name in VALUE_COLUMNS}}
    ts = F.when(F.col("_raw_ts") > MICROSECOND_FLOOR, F.expr("_raw_ts div 1000")).otherwise(
        F.col("_raw_ts")
    )
    return with_computed(df, numbers).withColumns({"ts": ts, "_reason": _reject_reason(ts)})


def _reject_reason(ts: Column) -> Column:
    bad_values = F.lit(False)
    for name in VALUE_COLUMNS:
        bad_values = bad_values | F.col(f"_{name}").isNull()
    return (
        F.when(F.col("_raw_ts").isNull(), "bad_open_time")
        .when(~ts.between(MIN_OPEN_TIME_MS, MAX_OPEN_TIME_MS), "out_of_range")
        .when(bad_values, "bad_values")
    )


def parse_kline_rows(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Text columns ``open_time, open … volume`` to typed bars; unreadable rows are dropped.

    ``symbol`` and ``interval`` come along from the input. Microsecond open times are
    brought to milliseconds first.
    """
    require_columns(df, ["open_time", "symbol", "interval", *VALUE_COLUMNS])
    return (
        _parsed_kline(df)
        .where(F.col("_reason").isNull())
        .select(
            *keep,
            "ts",
            iso_from_ms(F.col("ts")).alias("iso_ts"),
            "symbol",
            "interval",
            *[F.col(f"_{name}").alias(name) for name in VALUE_COLUMNS],
        )
    )


def kline_outcomes(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Every row, readable or not, in one pass: ``keep``, the bar columns and ``reason`` (null for a bar).

    Without a reason the columns are those of ``parse_kline_rows``; with one, the values that could be read.
    """
    require_columns(df, ["open_time", "symbol", "interval", *VALUE_COLUMNS])
    values = [F.col(f"_{name}").alias(name) for name in VALUE_COLUMNS]
    # a reject's time may lie outside what a timestamp can hold
    iso = F.when(F.col("_reason").isNull(), iso_from_ms(F.col("ts"))).alias("iso_ts")
    return _parsed_kline(df).select(*keep, "ts", iso, "symbol", "interval", *values, F.col("_reason").alias("reason"))


def kline_rejects(df: DataFrame) -> DataFrame:
    """The rows ``parse_kline_rows`` drops, with the reason."""
    columns = df.columns
    return (
        _parsed_kline(df)
        .where(F.col("_reason").isNotNull())
        .select(*columns, F.col("_reason").alias("reason"))
    )


def _page_entries(pages: DataFrame, body: str) -> DataFrame:
    """``_entries``: the arrays of a page's JSON body as texts; null where the body is not an array of arrays."""
    # without partial results a body that breaks off is null as a whole
    return pages.withColumn("_entries", F.from_json(F.col(body), "array<array<string>>", {"mode": "PERMISSIVE"}))


def api_page_rows(pages: DataFrame, body: str = "body", keep: Sequence[str] = ()) -> DataFrame:
    """Pages of an exchange's bar endpoint to the text rows that ``parse_kline_rows`` and ``kline_rejects`` take.

    A page is a JSON array of arrays: open time, open, high, low, close, volume and further values, as
    numbers or texts. ``symbol`` and ``interval`` come along from the page, ``entry`` is the place in it.
    Entries that are null or too short give null texts. Pages without a readable body give no row; see ``api_page_rejects``.
    """
    require_columns(pages, [body, "symbol", "interval", *keep])
    rows = _page_entries(pages, body).select(*keep, "symbol", "interval", F.posexplode("_entries").alias("entry", "_values"))
    names = ("open_time", *VALUE_COLUMNS)
    return rows.select(*keep, "symbol", "interval", "entry", *[F.get("_values", F.lit(i)).alias(name) for i, name in enumerate(names)])


def api_page_bars(pages: DataFrame, end: str | date | None = None, body: str = "body", keep: Sequence[str] = ()) -> DataFrame:
    """Typed bars of API pages, up to and including the day ``end``; unreadable entries are left out.

    Pages that overlap repeat bars; ``dedup_rows`` or a merging sink takes them out.
    """
    bars = parse_kline_rows(api_page_rows(pages, body, keep), keep)
    return bars if end is None else bars.where(F.col("ts") < utc_range_ms(end, end)[1])


def api_page_rejects(pages: DataFrame, body: str = "body", keep: Sequence[str] = ()) -> DataFrame:
    """What ``api_page_bars`` leaves out: ``keep, symbol, interval, entry, reason``; a ``bad_page`` has no entry.

    An empty array is a page without bars, not a fault.
    """
    entries = kline_rejects(api_page_rows(pages, body, keep)).select(*keep, "symbol", "interval", "entry", "reason")
    bad = _page_entries(pages, body).where(F.col("_entries").isNull())
    none = F.lit(None).cast("int")
    return entries.unionByName(bad.select(*keep, "symbol", "interval", none.alias("entry"), F.lit("bad_page").alias("reason")))


def bars_in_range(df: DataFrame, start: str | date, end: str | date) -> DataFrame:
    """Bars from ``start`` 00:00 UTC up to and including the day ``end``."""
    first, last = utc_range_ms(start, end)
    return df.where((F.col("ts") >= first) & (F.col("ts") < last))


def stored_range(df: DataFrame, column: str, start: str | date, end: str | date, zone: str = "UTC") -> DataFrame:
    """Rows whose stored zone-less UTC timestamp lies in the local days [start, end].

    The bounds are literals of the stored type, so they reach the scan; a range on a column
    computed from the timestamp does not. Filter here first and derive ``ts`` afterwards.
    """
    first, last = local_day_bounds_ms(start, zone)[0], local_day_bounds_ms(end, zone)[1]
    at = F.col(column)
    return df.where((at >= zoneless_stamp(first)) & (at < zoneless_stamp(last)))


def bar_rules() -> dict[str, Column]:
    """Each validation rule as a boolean column that is true when the rule is broken."""
    rules = {f"{name}_null": F.col(name).isNull() for name in ("symbol", "ts", *VALUE_COLUMNS)}
    rules |= {f"{name}_not_positive": F.col(name) <= 0 for name in PRICE_COLUMNS}
    rules["high_below_low"] = F.col("high") < F.col("low")
    rules["volume_negative"] = F.col("volume") < 0
    return rules


def rule_violations(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows checked and rows breaking each rule, in one aggregation."""
    counts = [F.count_if(broken).alias(name) for name, broken in bar_rules().items()]
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("checked"), *counts)


def dedup_rows(
    df: DataFrame,
    keys: Sequence[str],
    latest: Sequence[str | Column] = (),
    unique: bool = False,
) -> DataFrame:
    """One row per key: the greatest by ``latest``, then by the remaining columns.

    An aggregation rather than a window: copies of one key collapse before the shuffle,
    so a key that holds most of the table never meets in one task. ``unique`` promises that
    ``latest`` is one column without repeats inside a key; every column is then picked by itself,
    which numeric columns do by hash aggregation, without a sort.
    """
    rest = [name for name in df.columns if name not in keys]
    order = [F.col(c) if isinstance(c, str) else c for c in latest]
    if unique:
        if len(order) != 1:
            raise ValueError("unique needs exactly one column in latest")
        picked = [F.max_by(name, order[0]).alias(name) for name in rest]
        return df.groupBy(*keys).agg(*picked).select(*df.columns)
    rank = [c.alias(f"_o{i}") for i, c in enumerate(order)]
    best = F.max(F.struct(*rank, *rest)).alias("_best")
    return (
        df.groupBy(*keys)
        .agg(best)
        .select(*[F.col(n) if n in keys else F.col(f"_best.{n}").alias(n) for n in df.columns])
    )


def is_valid_bar() -> Column:
    """All rules kept. A null makes its comparison unknown, which a filter drops."""
    kept = F.col("symbol").isNotNull() & F.col("ts").isNotNull() & (F.col("volume") >= 0)
    for name in PRICE_COLUMNS:
        kept = kept & (F.col(name) > 0)
    return kept & (F.col("high") >= F.col("low"))


def validate_bars(
    df: DataFrame,
    dedup: bool = True,
    latest: Sequence[str | Column] = (),
    unique: bool = False,
    by: Sequence[str] = (),
) -> DataFrame:
    """Bars that keep every rule, typed in time, one per ``(symbol, open_ts)``.

    ``by`` names further key columns that stay in front, such as ``interval`` where bars of several
    widths meet. ``latest`` orders repeated keys (for example by arrival offset), ``unique`` as in ``dedup_rows``;
    without it the row with the greatest values wins, so the result never depends on partitioning.
    """
    require_columns(df, ["ts", "symbol", *VALUE_COLUMNS, *by])
    order = [F.col(c) if isinstance(c, str) else c for c in latest]
    names = [f"_latest{i}" for i in range(len(order))]
    aliased = [c.alias(n) for n, c in zip(names, order)]
    bars = df.where(is_valid_bar()).select(*by, "ts", "symbol", *VALUE_COLUMNS, *aliased)
    if dedup:
        bars = dedup_rows(bars, [*by, "symbol", "ts"], names, unique)
    return bars.select(
        *by,
        "symbol",
        timestamp_from_ms(F.col("ts")).alias("open_ts"),
        *VALUE_COLUMNS,
        F.to_date(timestamp_from_ms(F.col("ts"))).alias("date"),
    )


def with_month(df: DataFrame) -> DataFrame:
    """Add ``year`` and ``month`` of the bar date."""
    return df.withColumns(
        {"year": F.year("date").cast("int"), "month": F.month("date").cast("int")}
    )


def with_month_key(df: DataFrame) -> DataFrame:
    """Add ``month`` as ``YYYY-MM`` of ``ts`` in UTC."""
    return df.withColumn("month", month_key(F.col("ts")))


def month_batches(spark: SparkSession, start: str | date, end: str | date) -> DataFrame:
    """Calendar months covering [start, end], clamped to it."""
    first, last = as_date(start), as_date(end)
    if last < first:
        raise ValueError("end must not be before start")
    span = spark.range(1).select(F.lit(first).alias("s"), F.lit(last).alias("e"))
    return split_months(span, "s", "e").drop("s", "e")


def split_months(df: DataFrame, start: str, end: str) -> DataFrame:
    """One row per calendar month of each row's [start, end], clamped at both ends."""
    month = F.explode(
        F.sequence(F.trunc(F.col(start), "MM"), F.col(end), F.expr("interval 1 month"))
    )
    return df.withColumn("_m", month).select(
        *df.columns,
        F.year("_m").alias("year"),
        F.month("_m").alias("month"),
        F.greatest(F.col(start), F.col("_m")).alias("batch_start"),
        F.least(F.col(end), F.last_day("_m")).alias("batch_end"),
    )


def symbol_filter(df: DataFrame, symbols: Iterable[str] | DataFrame) -> DataFrame:
    """Keep the requested symbols: a literal list, or a frame with a ``symbol`` column."""
    if isinstance(symbols, DataFrame):
        return df.join(symbols.select("symbol"), "symbol", "left_semi").select(*df.columns)
    return df.where(F.col("symbol").isin(list(symbols)))


def enrich_ticks(df: DataFrame, source: str = FEED_SOURCE) -> DataFrame:
    """``ts, symbol, price`` with the ISO time and the feed tags."""
    return df.select(
        "ts",
        iso_from_ms(F.col("ts"), "+00:00").alias("iso_ts"),
        "symbol",
        "price",
        F.lit(TICKER_EVENT_TYPE).alias("event_type"),
        F.lit(source).alias("source"),
    )


def enrich_bars(df: DataFrame, source: str = FEED_SOURCE) -> DataFrame:
    """Bars with the ISO time and the feed tags, as they are published."""
    return df.select(
        "ts",
        "symbol",
        "interval",
        *VALUE_COLUMNS,
        iso_from_ms(F.col("ts"), "+00:00").alias("iso_ts"),
        F.lit(KLINE_EVENT_TYPE).alias("event_type"),
        F.lit(source).alias("source"),
    )
