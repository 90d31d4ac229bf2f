"""Registry of the runnable queries and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its name, with the SQL to compare it with, if any."""

    def register(fn: Query) -> Query:
        if fn.__name__ in QUERIES:
            raise ValueError(f"duplicate query {fn.__name__}")
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register
