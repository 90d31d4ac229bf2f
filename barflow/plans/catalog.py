"""All registered queries."""

from __future__ import annotations

from barflow.plans import (  # noqa: F401
    bar_queries,
    event_queries,
    series_queries,
    table_queries,
)
from barflow.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
