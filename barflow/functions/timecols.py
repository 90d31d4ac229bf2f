"""Time helpers: epoch columns, local calendar days, bar widths."""

from __future__ import annotations

from datetime import date, datetime, time, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

from barflow.constants import INTERVAL_SECONDS, LOCAL_ZONE


def as_date(day: str | date) -> date:
    return day if isinstance(day, date) else date.fromisoformat(day)


def interval_ms(interval: str) -> int:
    """Width of a named bar interval in milliseconds."""
    if interval not in INTERVAL_SECONDS:
        raise ValueError(f"unsupported interval {interval!r}; use one of {list(INTERVAL_SECONDS)}")
    return INTERVAL_SECONDS[interval] * 1000


def local_day_bounds_ms(day: str | date, zone: str = LOCAL_ZONE) -> tuple[int, int]:
    """[start, end) of a local calendar day in epoch ms; 23 or 25 hours on DST days."""
    start = as_date(day)

    def midnight(d: date) -> int:
        local = datetime.combine(d, time.min, tzinfo=ZoneInfo(zone))
        return int(local.astimezone(timezone.utc).timestamp()) * 1000

    return midnight(start), midnight(start + timedelta(days=1))


def utc_range_ms(start: str | date, end: str | date) -> tuple[int, int]:
    """[start 00:00 UTC, end + 1 day) in epoch ms."""
    return local_day_bounds_ms(start, "UTC")[0], local_day_bounds_ms(end, "UTC")[1]


def timestamp_from_ms(ts: Column) -> Column:
    return F.timestamp_millis(ts)


def local_day(ts: Column, zone: str = LOCAL_ZONE) -> Column:
    """Calendar date of an epoch-ms column in ``zone``, whatever the session's zone is."""
    return zone_date(timestamp_from_ms(ts), zone)


def zone_date(at: Column, zone: str) -> Column:
    """Calendar date of a timestamp in ``zone``. Reading the date off the shifted instant itself
    keeps the session's zone out of it."""
    days = F.floor(F.unix_millis(F.from_utc_timestamp(at, zone)) / 86_400_000)
    return F.date_from_unix_date(days.cast("int"))


def zoneless_stamp(ms: int) -> Column:
    """Literal TIMESTAMP_NTZ of an epoch time in UTC."""
    at = datetime.fromtimestamp(ms / 1000, timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.expr(f"TIMESTAMP_NTZ'{at}'")


def iso_from_ms(ts: Column, suffix: str = "Z") -> Column:
    """ISO-8601 text of an epoch-ms column; the fraction appears only when non-zero.

    Casting to text is several times cheaper than formatting with a pattern.
    """
    ms = F.pmod(ts, F.lit(1000))
    seconds = F.timestamp_millis(ts - ms).cast("string")
    fraction = F.when(ms == 0, "").otherwise(F.concat(F.lit("."), F.lpad(ms, 3, "0"), F.lit("000")))
    return F.concat(F.translate(seconds, " ", "T"), fraction, F.lit(suffix))


def bar_start_ms(ts: Column, interval: str) -> Column:
    """Start of the bar holding ``ts``; bars are aligned to the epoch."""
    width = interval_ms(interval)
    return ts - F.pmod(ts, F.lit(width))


def month_key(ts: Column) -> Column:
    """``YYYY-MM`` of an epoch-ms column in UTC."""
    return F.date_format(timestamp_from_ms(ts), "yyyy-MM")
