"""barflow: market bars, dated events and return statistics as Spark jobs."""

__version__ = "0.1.0"
