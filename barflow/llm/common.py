"""Reading, writing and naming helpers shared by the training-data operators."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import wraps
from weakref import WeakKeyDictionary

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barflow.session import drop_path, pin_settings, scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: White space that separates words: blank, tab, newline, vertical tab, form feed, return.
SPACE_CLASS = r"[\x20\x09-\x0D]"
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return pin_settings(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(df: DataFrame, rows: int = 512) -> DataFrame:
    """The same frame; rows of long texts go to Python a few at a time, which bounds a worker's memory."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    return df


#: Spark's setting that deletes the shuffle files of a query at its end.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_PATHS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
_HELD: ContextVar[list[DataFrame] | None] = ContextVar("held", default=None)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written below the shared folder and read back, so that its lineage ends there.

    What reads it again survives the loss of an executor, is not computed twice, and its size is
    known to the planner. ``release`` deletes the table once nothing reads it any more. The shuffle files
    of the write, which runs once, are deleted at its end and not when the driver happens to collect garbage.
    """
    path, conf = scratch_path(df.sparkSession, name), df.sparkSession.conf
    before = conf.get(SHUFFLE_CLEANUP, "false")
    conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.set(SHUFFLE_CLEANUP, before)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    _PATHS[table] = path
    held = _HELD.get()
    if held is not None:
        held.append(table)
    return table


def release(*tables: DataFrame) -> None:
    """Delete stored tables; other frames, and tables that are gone already, are left alone."""
    for table in tables:
        path = _PATHS.pop(table, None)
        if path is not None:
            drop_path(table.sparkSession, path)


@contextmanager
def tables() -> Iterator[list[DataFrame]]:
    """The tables stored inside, as a list. After an error they are deleted, else the scope around has them."""
    held: list[DataFrame] = []
    outer = _HELD.get()
    mark = _HELD.set(held)
    try:
        yield held
    except BaseException:
        release(*held)
        raise
    finally:
        _HELD.reset(mark)
    if outer is not None:
        outer.extend(held)


def cleaned(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """An operator that leaves no stored table behind when it fails."""

    @wraps(operator)
    def run(*args, **kwargs) -> DataFrame:
        with tables():
            return operator(*args, **kwargs)

    return run


def growing(df: DataFrame) -> DataFrame:
    """A join side that grows with the corpus: joined by shuffle at every size, never sent to all tasks."""
    return df.hint("merge")


def free_name(df: DataFrame, base: str) -> str:
    """A column name that the frame does not have yet, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def text_or_empty(column: str | Column) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def unsigned_crc32(column: Column) -> Column:
    """Of the UTF-8 bytes; a null has none."""
    return F.crc32(F.encode(F.coalesce(column, F.lit("")), "UTF-8"))
