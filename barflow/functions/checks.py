"""Plan-time checks: they look at the schema only and never start a job."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Return ``df`` unchanged, or fail when a column is missing."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns {missing}; found {df.columns}")
    return df


def require_date(df: DataFrame, column: str) -> DataFrame:
    """Fail unless ``column`` is a DATE.

    Series operators run one window per symbol. With one row per symbol and calendar
    date, such a window is bounded by the calendar however large the input was.
    """
    require_columns(df, [column])
    if not isinstance(df.schema[column].dataType, T.DateType):
        raise ValueError(f"{column} must be a DATE, found {df.schema[column].dataType}")
    return df
