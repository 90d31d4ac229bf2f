"""Exact quantiles by distributed selection.

``percentile`` keeps every distinct value of a group in one task. Here a quantile is a rank, and the
interval that holds it is narrowed: the values inside are counted in equal-width buckets, with each
bucket's least and greatest value, the bucket with the rank becomes the interval, and so on, until
it holds one distinct value or few rows. What is kept of a group is its intervals and, for one pass, their buckets.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barflow.functions.checks import require_columns
from barflow.session import drop_path, scratch_path

BUCKETS = 512
#: Rows of an interval that are ranked by sorting them.
FINISH_ROWS = 4096
#: Lines of intervals that are sent to all tasks; beyond that the join is left to Spark.
BROADCAST_LINES = 50_000


def _ranks(probabilities: Mapping[str, float], n: Column) -> Column:
    """The order statistics needed: the two around each position (n - 1) * p."""
    around = []
    for name, p in probabilities.items():
        at = F.floor((n - 1) * F.lit(float(p)))
        for side, rank in (("low", at), ("high", F.least(at + 1, n - 1))):
            around.append(F.struct(F.lit(f"{name}/{side}").alias("id"), rank.cast("bigint").alias("rank")))
    return F.array(*around)


def _bucket(buckets: int) -> Column:
    """Number of a value's bucket in [lo, hi]: equal widths, or by sign where an end is infinite.

    Least and greatest value never share a bucket, so every pass narrows an interval. Halves keep
    the width finite; where it vanishes all but the least value go together.
    """
    v, lo, hi = F.col("_value"), F.col("lo"), F.col("hi")
    infinity = F.lit(float("inf"))
    share = F.try_divide(v * 0.5 - lo * 0.5, hi * 0.5 - lo * 0.5)
    # least() passes over a null, so the vanished width is told apart first
    equal = F.when(share.isNull(), (v > lo).cast("int")).otherwise(F.least(F.floor(share * buckets), F.lit(buckets - 1)))
    sign = F.when(F.abs(v) < infinity, 0).otherwise(F.signum(v))
    return F.when((F.abs(lo) < infinity) & (F.abs(hi) < infinity), equal).otherwise(sign).cast("int")


def _met(rows: DataFrame, intervals: DataFrame, by: Sequence[str], lines: int) -> DataFrame:
    """The rows with the intervals that hold them, of which none overlap."""
    small = F.broadcast(intervals) if lines <= BROADCAST_LINES else intervals
    return rows.join(small, list(by)).where(F.col("_value").between(F.col("lo"), F.col("hi")))


def _narrowed(rows: DataFrame, intervals: DataFrame, by: Sequence[str], buckets: int, lines: int) -> DataFrame:
    """Each interval's buckets that hold a rank, as intervals."""
    key = [*by, "lo", "hi"]
    counted = _met(rows, intervals, by, lines).groupBy(*key, _bucket(buckets).alias("bucket")).agg(
        F.count(F.lit(1)).alias("rows"), F.min("_value").alias("least"), F.max("_value").alias("most")
    )
    before = Window.partitionBy(*key).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.withColumn("before", F.coalesce(F.sum("rows").over(before), F.lit(0)))
    again = intervals.select(*key, "below", "ranks", "n")
    start = F.col("below") + F.col("before")
    held = F.filter("ranks", lambda r: (r["rank"] >= start) & (r["rank"] < start + F.col("rows")))
    return (
        placed.join(F.broadcast(again) if lines <= BROADCAST_LINES else again, key)
        .withColumn("ranks", held)
        .where(F.size("ranks") > 0)
        .select(*by, F.col("least").alias("lo"), F.col("most").alias("hi"), start.alias("below"), F.col("rows").alias("inside"), "ranks", "n")
    )


def exact_quantiles(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    probabilities: Mapping[str, float],
    buckets: int = BUCKETS,
    finish_rows: int = FINISH_ROWS,
) -> DataFrame:
    """``by`` columns and one column per name: the quantile between order statistics, as ``percentile`` gives it.

    Null and NaN values do not count; groups without a value have no row. A group may have a null key. Starts jobs:
    the values are written to the shared folder once, and one small table a pass, of which the driver reads
    how many intervals are still wide; groups of ``finish_rows`` values or fewer need no pass. All but the
    result is deleted at the end. Infinite values are ranked like others;
    a quantile between an infinite and another value is infinite.
    """
    require_columns(df, [*by, value])
    if not probabilities or not all(0 <= p <= 1 for p in probabilities.values()):
        raise ValueError("probabilities must lie in [0, 1]")
    spark, paths = df.sparkSession, []
    keys = [f"_key{i}" for i in range(len(by))]
    number = F.col(value).cast("double")
    # keys may be null, also in joins: a struct of the columns is not
    named = [F.struct(F.col(c)).alias(k) for c, k in zip(by, keys)]
    values = df.where(number.isNotNull() & ~F.isnan(number)).select(*named, number.alias("_value"))
    n = F.col("inside")
    wide = (n > finish_rows) & (F.col("lo") < F.col("hi"))

    def written(table: DataFrame, name: str) -> DataFrame:
        paths.append(scratch_path(spark, name))
        table.write.parquet(paths[-1])
        return spark.read.schema(table.schema).parquet(paths[-1])

    try:
        rows = written(values, "values")
        whole = rows.groupBy(*keys).agg(
            F.min("_value").alias("lo"), F.max("_value").alias("hi"), F.count(F.lit(1)).alias("inside")
        )
        intervals = whole.select(
            *keys, "lo", "hi", F.lit(0).cast("bigint").alias("below"), n, _ranks(probabilities, n).alias("ranks"), n.alias("n")
        )
        while True:
            intervals = written(intervals, "intervals")
            left, lines = intervals.agg(F.count_if(wide), F.count(F.lit(1))).first()
            if not left:
                break
            finer = _narrowed(rows, intervals.where(wide), keys, buckets, lines)
            intervals = intervals.where(~wide).unionByName(finer)
        result = _picked(rows, intervals, keys, probabilities, lines)
        result = result.select(*[F.col(k)[c].alias(c) for c, k in zip(by, keys)], *probabilities)
        out = written(result, "quantiles")
        paths.pop()
        return out
    finally:
        for path in paths:
            drop_path(spark, path)


def _picked(rows: DataFrame, intervals: DataFrame, by: Sequence[str], probabilities: Mapping[str, float], lines: int) -> DataFrame:
    """The values at the ranks, and between them."""
    many = F.col("lo") < F.col("hi")
    key = [*by, "lo", "hi", "below", "ranks", "n"]
    # an interval holds finish_rows values at most here
    sorted_values = _met(rows, intervals.where(many), by, lines).groupBy(*key).agg(F.sort_array(F.collect_list("_value")).alias("values"))
    at = lambda r: F.struct(r["id"].alias("id"), F.get("values", (r["rank"] - F.col("below")).cast("int")).alias("v"))
    few = sorted_values.select(*by, "n", F.transform("ranks", at).alias("found"))
    one = intervals.where(~many).select(
        *by, "n", F.transform("ranks", lambda r: F.struct(r["id"].alias("id"), F.col("lo").alias("v"))).alias("found")
    )
    found = few.unionByName(one).select(*by, "n", F.inline("found"))
    wanted = [F.max(F.when(F.col("id") == f"{name}/{side}", F.col("v"))).alias(f"{name}/{side}") for name in probabilities for side in ("low", "high")]
    table = found.groupBy(*by, "n").agg(*wanted)
    columns = []
    for name, p in probabilities.items():
        low, high = F.col(f"`{name}/low`"), F.col(f"`{name}/high`")
        position = (F.col("n") - 1) * F.lit(float(p))
        part = position - F.floor(position)
        columns.append(F.when((low == high) | (part == 0), low).otherwise((1 - part) * low + part * high).alias(name))
    return table.select(*by, *columns)
