"""Expensive columns that must not be repeated by the optimiser."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_computed(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns that are evaluated once per row, however often they are used later.

    A filter on a projected column is normally pushed below the projection with the expression
    copied into it, once per use. Filters on what a generator produced stay above it, and filters
    on the other columns still reach the scan.
    """
    row = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select("*", F.inline_outer(F.array(row)))
