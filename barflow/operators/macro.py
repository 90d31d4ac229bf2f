"""Dated macro releases: flattening, sentiment, decision classes, joins with prices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barflow.constants import MACRO_SENTIMENT_SOURCE
from barflow.functions.checks import require_columns

NUMERIC_COLUMNS = ("actual", "forecast", "previous")


def _double(df: DataFrame, name: str) -> Column:
    """The column as a double; unreadable text becomes null instead of an error."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.trim(F.col(name)).try_cast("double")
    return F.col(name).cast("double")


def _doubles(df: DataFrame) -> dict[str, Column]:
    return {name: _double(df, name) for name in NUMERIC_COLUMNS if name in df.columns}


def _date(df: DataFrame, name: str) -> Column:
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.col(name).try_cast("date")
    return F.to_date(name)


def with_event_month(df: DataFrame) -> DataFrame:
    return df.withColumns({"event_year": F.year("event_date"), "event_month": F.month("event_date")})


def flatten_macro(df: DataFrame) -> DataFrame:
    """Nested release rows to flat ones with numbers, year, month and an event id."""
    require_columns(df, ["event_type", "event_date", "extra", *NUMERIC_COLUMNS])
    nested = df.schema["extra"].dataType.fieldNames()
    extras = {
        name: F.col(f"extra.{name}") if name in nested else F.lit(None).cast("string")
        for name in ("period_month", "local_time_str")
    }
    dated = df.withColumns({"event_date": _date(df, "event_date"), **_doubles(df), **extras})
    event_id = F.concat_ws("-", "event_type", F.date_format("event_date", "yyyy-MM-dd"))
    return with_event_month(dated.drop("extra")).withColumn("event_id", event_id)


def ensure_event_type(df: DataFrame) -> DataFrame:
    """Recover a missing ``event_type`` from the text before the first dash of ``event_id``."""
    if "event_type" in df.columns:
        return df
    prefix = F.regexp_extract("event_id", r"^([^-]+)", 1)
    return df.withColumn(
        "event_type", F.when(F.col("event_id").isNotNull(), prefix).otherwise("unknown")
    )


def event_sentiment(df: DataFrame) -> DataFrame:
    """``actual − previous`` and its sign turned round: a rise is −1, a fall +1."""
    require_columns(df, ["actual", "previous"])
    delta = _double(df, "actual") - _double(df, "previous")
    sign = F.when(delta > 0, -1).when(delta < 0, 1).otherwise(0)
    return df.withColumns({"event_delta": delta, "event_sentiment": sign.cast("int")})


def retag_source(df: DataFrame, source: str = MACRO_SENTIMENT_SOURCE) -> DataFrame:
    return with_event_month(df).withColumn("source", F.lit(source))


def sentiment_events(df: DataFrame, source: str = MACRO_SENTIMENT_SOURCE) -> DataFrame:
    """Flat releases to sentiment rows under their own source tag."""
    dated = ensure_event_type(df.withColumn("event_date", _date(df, "event_date")))
    return retag_source(event_sentiment(dated.withColumns(_doubles(dated))), source)


def decision_class(df: DataFrame) -> DataFrame:
    """Add rate, delta and the class hike, cut, hold or unknown.

    The rate is the actual value, or the forecast where no actual is known yet.
    """
    require_columns(df, ["event_date", *NUMERIC_COLUMNS])
    numbers = df.withColumns({"event_date": _date(df, "event_date"), **_doubles(df)})
    rated = numbers.withColumn("rate", F.coalesce("actual", "forecast")).withColumn(
        "delta", F.col("rate") - F.col("previous")
    )
    label = (
        F.when(F.col("delta") > 0, "hike")
        .when(F.col("delta") < 0, "cut")
        .when(F.col("delta") == 0, "hold")
        .otherwise("unknown")
    )
    return rated.withColumn("decision_class", label)


def events_per_day(df: DataFrame, by: Sequence[str] = ("event_type",)) -> DataFrame:
    """Events counted per date and kind, so that busy days meet prices as one row."""
    score = F.avg("event_sentiment") if "event_sentiment" in df.columns else F.lit(None)
    return df.groupBy("event_date", *by).agg(
        F.count(F.lit(1)).alias("events"), score.cast("double").alias("avg_sentiment")
    )


def event_price_join(events: DataFrame, candles: DataFrame) -> DataFrame:
    """Each event with the candles of its day; events on days without one stay, with nulls."""
    return events.join(candles, events["event_date"] == candles["day"], "left").drop("day")


def event_move_summary(joined: DataFrame, by: Sequence[str] = ("event_type",)) -> DataFrame:
    """Price move on event days per symbol and event kind."""
    move = F.try_divide(F.col("close"), F.col("open")) - 1
    span = F.try_divide(F.col("high") - F.col("low"), F.col("open"))
    return (
        joined.where(F.col("symbol").isNotNull())
        .groupBy("symbol", *by)
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.avg(move).alias("avg_move"),
            F.avg(span).alias("avg_range"),
            F.sum("volume").alias("volume"),
        )
    )
