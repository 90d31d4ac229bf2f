"""Per-symbol moments, histograms and density tables of a return series.

Everything here is a plain aggregation with partial sums before the shuffle, but for the selection of quantiles in
``clip_central``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.constants import CI_Z, HISTOGRAM_BINS, TAIL_THRESHOLD
from barflow.functions.checks import require_columns
from barflow.functions.numerics import normal_pdf
from barflow.operators.quantiles import exact_quantiles


def describe_returns(df: DataFrame, value: str = "ret", z: float = CI_Z) -> DataFrame:
    """Count, mean, variance, skewness, excess kurtosis and the interval of the mean.

    Skewness and kurtosis are the bias-corrected forms; Spark's own are population moments.
    Symbols with fewer than two observations have no row.
    """
    require_columns(df, ["symbol", value])
    n = F.col("n")
    g1, g2 = F.col("_g1"), F.col("_g2")
    margin = F.lit(z) * F.col("std") / F.sqrt(n)
    # a series without spread has moments 0, not 0 / 0
    flat = F.col("variance") == 0
    skewness = F.when(n > 2, F.when(flat, 0.0).otherwise(g1 * F.sqrt(n * (n - 1)) / (n - 2)))
    excess = (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6)
    kurtosis = F.when(n > 3, F.when(flat, 0.0).otherwise(excess))
    return (
        df.groupBy("symbol")
        .agg(
            F.count(value).alias("n"),
            F.avg(value).alias("mean"),
            F.var_samp(value).alias("variance"),
            F.stddev_samp(value).alias("std"),
            F.skewness(value).alias("_g1"),
            F.kurtosis(value).alias("_g2"),
        )
        .where(n >= 2)
        .select(
            "symbol",
            "n",
            "mean",
            "variance",
            "std",
            skewness.alias("skewness"),
            kurtosis.alias("kurtosis"),
            (F.col("mean") - margin).alias("ci_lower"),
            (F.col("mean") + margin).alias("ci_upper"),
        )
    )


def fit_normal(df: DataFrame, value: str = "ret") -> DataFrame:
    """Mean and sample standard deviation; symbols with no spread have no row."""
    return (
        df.groupBy("symbol")
        .agg(
            F.count(value).alias("n"),
            F.avg(value).alias("mu"),
            F.stddev_samp(value).alias("sigma"),
        )
        .where((F.col("n") >= 2) & (F.col("sigma") > 0))
    )


def tail_prob_empirical(
    df: DataFrame, threshold: float = TAIL_THRESHOLD, value: str = "ret"
) -> DataFrame:
    """Share of observations with an absolute value above ``threshold``."""
    beyond = F.when(F.abs(value) > threshold, 1.0).otherwise(0.0)
    return (
        df.where(F.col(value).isNotNull())
        .groupBy("symbol")
        .agg(F.avg(beyond).alias("tail_empirical"))
    )


def _edges(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Per-symbol first edge, bin width and size; a constant series gets a width-one range."""
    low, high = F.col("_min"), F.col("_max")
    flat = low == high
    return (
        df.groupBy("symbol")
        .agg(F.min(value).alias("_min"), F.max(value).alias("_max"), F.count(value).alias("n"))
        .where(F.col("n") > 0)
        .select(
            "symbol",
            "n",
            F.when(flat, low - 0.5).otherwise(low).alias("first_edge"),
            F.when(flat, F.lit(1.0)).otherwise(high - low).alias("_span"),
        )
        .withColumn("width", F.col("_span") / bins)
        .drop("_span")
    )


def clip_central(df: DataFrame, share: float = 0.99, value: str = "ret") -> DataFrame:
    """Rows inside the central ``share`` of each symbol's values, both limits included.

    The limits are exact quantiles, selected by passes over the values: see ``exact_quantiles``.
    """
    tail = (1 - share) / 2
    limits = exact_quantiles(df, ["symbol"], value, {"_low": tail, "_high": 1 - tail})
    return (
        df.join(limits, "symbol")
        .where(F.col(value).between(F.col("_low"), F.col("_high")))
        .select(*df.columns)
    )


def histogram(df: DataFrame, bins: int = HISTOGRAM_BINS, value: str = "ret") -> DataFrame:
    """Equal-width counts and density per symbol, empty bins included.

    The last edge belongs to the last bin.
    """
    edges = _edges(df, value, bins)
    index = F.least(
        F.floor((F.col(value) - F.col("first_edge")) / F.col("width")), F.lit(bins - 1)
    )
    # Counts of a symbol meet as one map of at most ``bins`` entries, from which empty bins are
    # filled in without a join.
    shape = ("symbol", "n", "first_edge", "width")
    counted = (
        df.where(F.col(value).isNotNull())
        .select("symbol", value)
        .join(edges, "symbol")
        .groupBy(*shape, index.cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .groupBy(*shape)
        .agg(F.map_from_entries(F.collect_list(F.struct("bin", "rows"))).alias("_counts"))
    )
    observed = F.coalesce(F.try_element_at("_counts", F.col("bin")), F.lit(0))
    edge = F.col("first_edge") + F.col("bin") * F.col("width")
    upper = F.col("first_edge") + (F.col("bin") + 1) * F.col("width")
    return (
        counted.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
        .withColumn("observed", observed.cast("bigint"))
        .select(
            "symbol",
            "bin",
            "n",
            edge.alias("lower"),
            upper.alias("upper"),
            "observed",
            (F.col("observed") / (F.col("n") * F.col("width"))).alias("density"),
        )
    )


def density_grid(df: DataFrame, params: DataFrame, points: int = 1000, value: str = "ret") -> DataFrame:
    """Fitted normal and Student-t densities on ``points`` equally spaced values per symbol.

    ``params`` holds ``mu, sigma, df, loc, scale`` and ``t_log_norm`` per symbol, as
    ``fits.fit_params`` gives them.
    """
    span = df.groupBy("symbol").agg(F.min(value).alias("_min"), F.max(value).alias("_max"))
    x = F.col("_min") + (F.col("_max") - F.col("_min")) * F.col("point") / (points - 1)
    z = (F.col("x") - F.col("loc")) / F.col("scale")
    log_t = F.col("t_log_norm") - (F.col("df") + 1) / 2 * F.log1p(z * z / F.col("df"))
    return (
        span.join(params, "symbol")
        .withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
        .withColumn("x", x)
        .select(
            "symbol",
            "point",
            "x",
            normal_pdf(F.col("x"), F.col("mu"), F.col("sigma")).alias("normal_density"),
            F.exp(log_t).alias("t_density"),
        )
    )
