"""Roll-ups of bars and ticks: candles, resampling, latest values."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from barflow.constants import HISTORY_TAIL, INTERVAL_SECONDS, LOCAL_ZONE
from barflow.functions.checks import require_columns
from barflow.functions.timecols import bar_start_ms, interval_ms, local_day
from barflow.operators.klines import VALUE_COLUMNS, dedup_rows
from barflow.schemas import CANDLE_COLUMNS


def _order(columns: Sequence[str]) -> Column:
    """A single column orders by itself (hash aggregation); several by their struct."""
    return F.col(columns[0]) if len(columns) == 1 else F.struct(*columns)


def candle_aggregates(order: Sequence[str] = ("ts",)) -> list[Column]:
    """First open, high, low, last close, volume and row count, all partially aggregable."""
    by = _order(order)
    return [
        F.min_by("open", by).alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", by).alias("close"),
        F.sum("volume").alias("volume"),
        F.count(F.lit(1)).alias("rows"),
    ]


def bars_daily(
    df: DataFrame,
    zone: str = LOCAL_ZONE,
    dedup: bool = False,
    latest: Sequence[str | Column] = (),
    order: Sequence[str] = ("ts",),
    unique: bool = False,
) -> DataFrame:
    """One candle per symbol and local calendar day.

    ``order`` decides open and close; it is UTC time, which never repeats, and may carry a
    tie-break. ``dedup`` first keeps the last arrival per ``(symbol, ts)``, so a re-emitted
    bar counts once; ``latest`` and ``unique`` are those of ``dedup_rows``.
    """
    require_columns(df, ["ts", "symbol", *VALUE_COLUMNS, *order])
    if dedup:
        arrival = [(F.col(c) if isinstance(c, str) else c) for c in latest]
        names = [f"_latest{i}" for i in range(len(arrival))]
        needed = dict.fromkeys(["symbol", "ts", *VALUE_COLUMNS, *order])
        df = df.select(*needed, *[c.alias(n) for n, c in zip(names, arrival)])
        df = dedup_rows(df, ["symbol", "ts"], names, unique)
    return (
        df.withColumn("day", local_day(F.col("ts"), zone))
        .groupBy("symbol", "day")
        .agg(*candle_aggregates(order))
        .select(*CANDLE_COLUMNS)
    )


def resample_bars(df: DataFrame, interval: str, order: Sequence[str] = ("ts",)) -> DataFrame:
    """Roll bars up to one of the supported widths, aligned to the epoch."""
    require_columns(df, ["ts", "symbol", *VALUE_COLUMNS, *order])
    return (
        df.withColumn("bar_ts", bar_start_ms(F.col("ts"), interval))
        .groupBy("symbol", "bar_ts")
        .agg(*candle_aggregates(order))
        .select(
            F.col("bar_ts").alias("ts"),
            "symbol",
            F.lit(interval).alias("interval"),
            *VALUE_COLUMNS,
            "rows",
        )
    )


def _folded(partials: DataFrame, widths: dict[str, int]) -> DataFrame:
    """Bars of several widths from narrower ones; ``block`` keeps them where they are."""
    each = F.array(*[F.struct(F.lit(name).alias("interval"), F.lit(ms).alias("ms")) for name, ms in widths.items()])
    return (
        partials.withColumn("_width", F.explode(each))
        .withColumn("bar_ts", F.col("ts") - F.pmod(F.col("ts"), F.col("_width.ms")))
        .groupBy("symbol", "block", F.col("_width.interval").alias("interval"), "bar_ts")
        .agg(*candle_aggregates()[:-1], F.sum("rows").alias("rows"))
        .withColumnRenamed("bar_ts", "ts")
    )


def resample_cascade(
    df: DataFrame, intervals: Sequence[str] = tuple(INTERVAL_SECONDS), order: Sequence[str] = ("ts",), step: str = "15m"
) -> DataFrame:
    """Bars of all ``intervals`` at once, as ``resample_bars`` gives them one by one.

    The input is rolled up to the narrowest width that divides all others, the only exchange that it takes
    part in. These partial candles are dealt by symbol and block of the widest width, where
    all further roll-ups stay: widths below ``step`` come from the narrowest bars, those that are
    multiples of it from bars of ``step``. Every interval must divide the widest one.
    """
    require_columns(df, ["ts", "symbol", *VALUE_COLUMNS, *order])
    widths = {name: interval_ms(name) for name in dict.fromkeys(intervals)}
    if not widths:
        raise ValueError("name at least one interval")
    widest, narrowest, stride = max(widths.values()), math.gcd(*widths.values()), interval_ms(step)
    odd = [name for name, ms in widths.items() if widest % ms]
    if odd:
        raise ValueError(f"{odd} do not divide the widest interval")

    def start(ms: int) -> Column:
        return F.col("ts") - F.pmod(F.col("ts"), F.lit(ms))

    partials = (
        df.withColumn("bar_ts", start(narrowest))
        .groupBy("symbol", "bar_ts")
        .agg(*candle_aggregates(order))
        .withColumnRenamed("bar_ts", "ts")
        .withColumn("block", start(widest))
        .repartition("symbol", "block")
    )
    coarse = {name: ms for name, ms in widths.items() if ms % stride == 0 and widest % stride == 0}
    fine = {name: ms for name, ms in widths.items() if name not in coarse}
    parts = [_folded(partials, fine)] if fine else []
    if coarse:
        steps = _folded(partials, {step: stride}).drop("interval")
        parts.append(_folded(steps, coarse))
    columns = ["ts", "symbol", "interval", *VALUE_COLUMNS, "rows"]
    return reduce(DataFrame.unionByName, parts).select(*columns)


def ticks_as_bars(df: DataFrame, price: str = "price", volume: str = "volume") -> DataFrame:
    """Ticks in bar shape, so that every roll-up accepts them; other columns are kept."""
    keep = [c for c in df.columns if c not in (price, volume)]
    prices = {name: F.col(price) for name in ("open", "high", "low", "close")}
    return df.withColumns({**prices, "_volume": F.col(volume)}).select(
        *keep, *prices, F.col("_volume").alias("volume")
    )


def daily_close(
    df: DataFrame, ds: Column | None = None, order: Sequence[str] = ("ts",)
) -> DataFrame:
    """Last non-null close per symbol and date.

    ``ds`` defaults to the UTC date of ``ts``. The result has one row per symbol and date,
    which is what the series operators rely on.
    """
    day = ds if ds is not None else local_day(F.col("ts"), "UTC")
    return (
        df.withColumn("ds", day)
        .where(F.col("symbol").isNotNull() & F.col("ds").isNotNull() & F.col("close").isNotNull())
        .groupBy("symbol", "ds")
        .agg(F.max_by("close", _order(order)).alias("close"))
    )


def daily_close_from_text(df: DataFrame, order: Sequence[str] = ("iso_ts",)) -> DataFrame:
    """``daily_close`` of ``iso_ts, symbol, close`` rows as the daily CSV holds them."""
    require_columns(df, ["iso_ts", "symbol", "close"])
    at = F.try_to_timestamp(F.col("iso_ts"))
    return daily_close(df.withColumn("_at", at), F.col("_at").cast("date"), ("_at", *order))


def dedup_dates(df: DataFrame, value: str, keep: str, order: Sequence[str]) -> DataFrame:
    """First or last row per symbol and date."""
    pick = {"first": F.min_by, "last": F.max_by}
    if keep not in pick:
        raise ValueError("keep must be 'first' or 'last'")
    return df.groupBy("symbol", "ds").agg(pick[keep](value, _order(order)).alias(value))


def latest_value(df: DataFrame, value: str, order: Sequence[str] = ("ds",)) -> DataFrame:
    """Last value per symbol."""
    return df.groupBy("symbol").agg(F.max_by(value, _order(order)).alias(value))


def latest_bar(df: DataFrame, order: Sequence[str] = ("ts",)) -> DataFrame:
    """Most recent bar per symbol, as a partial aggregate instead of a window."""
    return dedup_rows(df, ["symbol"], order)


def tail_n(
    df: DataFrame, n: int = HISTORY_TAIL, order: Sequence[str] = ("ds",), by: str = "symbol"
) -> DataFrame:
    """Last ``n`` rows per series; the rank limit is applied before the shuffle as well."""
    w = Window.partitionBy(by).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= n).drop("_rank")


def next_day(df: DataFrame) -> DataFrame:
    """Last date plus one per symbol."""
    return df.groupBy("symbol").agg(F.date_add(F.max("ds"), 1).alias("ds"))


def forecast_calendar(df: DataFrame, horizon: int) -> DataFrame:
    """The ``horizon`` dates after each symbol's last one, with their step number."""
    if horizon < 1:
        raise ValueError("horizon must be at least 1")
    last = df.groupBy("symbol").agg(F.max("ds").alias("_last"))
    return last.select(
        "symbol", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"), "_last"
    ).select("symbol", "step", F.date_add("_last", F.col("step")).alias("ds"))


def sort_for_files(df: DataFrame, partition: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows of one output partition together and in order.

    Ranges are cut over partition *and* order columns, so a partition that holds a large share
    of the rows is spread over tasks and its files cover disjoint, ascending ranges.
    """
    return df.repartitionByRange(*partition, *order).sortWithinPartitions(*partition, *order)


def batch_counters(
    df: DataFrame, good: Column, by: Sequence[str] = ("symbol",)
) -> DataFrame:
    """Rows attempted, good and failed per batch."""
    flag = F.coalesce(good, F.lit(False))
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("attempted"),
        F.count_if(flag).alias("ok"),
        F.count_if(~flag).alias("fail"),
    )


def observed(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """``df`` plus an observation that holds the row count once the job has run.

    Reporting the rows of a write this way needs no second execution of the plan.
    """
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def union_symbols(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of several frames, matched by column name; missing columns become null."""
    if not frames:
        raise ValueError("at least one frame is needed")
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out
