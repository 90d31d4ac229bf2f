"""Daily return series: one row per symbol and date, order only through windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from barflow.functions.checks import require_columns, require_date


def by_date(order: str = "ds") -> WindowSpec:
    return Window.partitionBy("symbol").orderBy(order)


def _previous(df: DataFrame, value: str) -> DataFrame:
    require_columns(df, ["symbol", "ds", value])
    require_date(df, "ds")
    return df.withColumn("_prev", F.lag(value).over(by_date()))


def log_returns(df: DataFrame, close: str = "close") -> DataFrame:
    """``ln(close / previous close)`` per symbol; rows without a positive ratio are dropped."""
    ratio = F.try_divide(F.col(close), F.col("_prev"))
    return (
        _previous(df, close)
        .withColumn("ret", F.when(ratio > 0, F.ln(ratio)))
        .where(F.col("ret").isNotNull())
        .select("symbol", "ds", "ret")
    )


def simple_returns(df: DataFrame, close: str = "close") -> DataFrame:
    """``close / previous close − 1`` per symbol; rows without a value are dropped."""
    ratio = F.try_divide(F.col(close), F.col("_prev"))
    return (
        _previous(df, close)
        .withColumn("ret", ratio - 1)
        .where(F.col("ret").isNotNull())
        .select("symbol", "ds", "ret")
    )


def lag_design(df: DataFrame, value: str = "ret", lags: int = 1) -> DataFrame:
    """Each value with its ``lags`` predecessors; rows without all of them are dropped."""
    require_columns(df, ["symbol", "ds", value])
    require_date(df, "ds")
    names = [f"lag{i}" for i in range(1, lags + 1)]
    lagged = df.where(F.col(value).isNotNull()).withColumns(
        {name: F.lag(value, i).over(by_date()) for i, name in enumerate(names, start=1)}
    )
    # Lags of a null-free series are missing only at its start.
    return lagged.where(F.col(names[-1]).isNotNull())


def cumulative_path(df: DataFrame, value: str = "ret", start: Column | float = 1.0) -> DataFrame:
    """Running sum of log returns and the price path it implies from ``start``."""
    require_date(df, "ds")
    base = start if isinstance(start, Column) else F.lit(float(start))
    total = F.sum(value).over(by_date().rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumn("cum_log_ret", total).withColumn(
        "price", base * F.exp(F.col("cum_log_ret"))
    )


def empirical_rank(df: DataFrame, value: str = "ret", tie: Sequence[str] = ("ds",)) -> DataFrame:
    """Rank ``i``, series length ``n`` and plotting position ``(i − 0.5) / n`` per symbol."""
    require_date(df, "ds")
    order = Window.partitionBy("symbol").orderBy(value, *tie)
    whole = Window.partitionBy("symbol")
    return (
        df.where(F.col(value).isNotNull())
        .withColumns({"i": F.row_number().over(order), "n": F.count(F.lit(1)).over(whole)})
        .withColumn("position", (F.col("i") - 0.5) / F.col("n"))
    )


def rolling_return(df: DataFrame, days: int, value: str = "ret") -> DataFrame:
    """Simple return over each run of ``days`` consecutive log returns; partial runs are dropped."""
    require_date(df, "ds")
    frame = by_date().rowsBetween(-(days - 1), 0)
    return (
        df.withColumns(
            {"_run": F.count(value).over(frame), "_sum": F.sum(value).over(frame)}
        )
        .where(F.col("_run") == days)
        .select("symbol", "ds", (F.exp("_sum") - 1).alias("ret"))
    )
