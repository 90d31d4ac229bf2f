"""Lag regressions and their diagnostics, per symbol, from regression aggregates."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barflow.functions.numerics import chi2_sf, student_t_two_sided
from barflow.operators.bars import latest_value
from barflow.operators.returns import by_date, lag_design


def _line(y: str, x: str) -> dict[str, Column]:
    return {
        "n": F.regr_count(y, x),
        "const": F.regr_intercept(y, x),
        "lag1": F.regr_slope(y, x),
        "r2": F.regr_r2(y, x),
        "_sxx": F.regr_sxx(y, x),
        "_syy": F.regr_syy(y, x),
        "_sxy": F.regr_sxy(y, x),
        "_avgx": F.regr_avgx(y, x),
    }


def ar1_fit(df: DataFrame, value: str = "ret") -> DataFrame:
    """Least squares of each value on its predecessor: coefficients, p-values, R².

    Needs three pairs and a lag that varies; other symbols have no row.
    """
    terms = _line(value, "lag1")
    fit = (
        lag_design(df, value)
        .groupBy("symbol")
        .agg(*[column.alias(name) for name, column in terms.items()])
        .where((F.col("n") >= 3) & (F.col("_sxx") > 0))
    )
    variance = (F.col("_syy") - F.col("lag1") * F.col("_sxy")) / (F.col("n") - 2)
    se_lag = F.sqrt(F.col("_s2") / F.col("_sxx"))
    se_const = F.sqrt(
        F.col("_s2") * (1 / F.col("n") + F.col("_avgx") * F.col("_avgx") / F.col("_sxx"))
    )
    dof = (F.col("n") - 2).cast("double")

    def p_value(name: str, error: Column) -> Column:
        return student_t_two_sided(F.try_divide(F.col(name), error), dof)

    return fit.withColumn("_s2", F.greatest(variance, F.lit(0.0))).select(
        "symbol",
        "n",
        "const",
        "lag1",
        p_value("const", se_const).alias("p_const"),
        p_value("lag1", se_lag).alias("p_lag1"),
        "r2",
    )


def ar1_fitted(df: DataFrame, fit: DataFrame, value: str = "ret") -> DataFrame:
    """Actual, fitted and residual value of every pair."""
    coefficients = fit.select("symbol", F.col("const").alias("_a"), F.col("lag1").alias("_b"))
    return (
        lag_design(df, value)
        .join(coefficients, "symbol")
        .withColumn("fitted", F.col("_a") + F.col("_b") * F.col("lag1"))
        .select(
            "symbol",
            "ds",
            F.col(value).alias("actual"),
            "fitted",
            (F.col(value) - F.col("fitted")).alias("residual"),
        )
    )


def ar1_forecast(df: DataFrame, fit: DataFrame, value: str = "ret") -> DataFrame:
    """One step ahead of each symbol's last value."""
    return (
        fit.join(latest_value(df, value), "symbol")
        .select("symbol", (F.col("const") + F.col("lag1") * F.col(value)).alias("forecast"))
    )


def residual_diagnostics(
    residuals: DataFrame, parameters: int = 2, value: str = "residual"
) -> DataFrame:
    """AIC, Durbin–Watson, Jarque–Bera and lag-one Ljung–Box of a residual column."""
    e, before = F.col(value), F.col("_before")
    n = F.col("n")
    pairs = residuals.where(e.isNotNull()).withColumn("_before", F.lag(value).over(by_date()))
    sums = pairs.groupBy("symbol").agg(
        F.count(e).alias("n"),
        F.sum(e * e).alias("_ss"),
        F.sum((e - before) * (e - before)).alias("_dd"),
        F.skewness(e).alias("skewness"),
        F.kurtosis(e).alias("excess_kurtosis"),
        F.avg(e).alias("_mean"),
        F.var_pop(e).alias("_var"),
        F.sum(e * before).alias("_cross"),
        F.sum(F.when(before.isNotNull(), e + before)).alias("_cross_sum"),
        F.count(before).alias("_m"),
    )
    mean = F.col("_mean")
    autocovariance = F.col("_cross") - mean * F.col("_cross_sum") + F.col("_m") * mean * mean
    rho = F.try_divide(autocovariance, n * F.col("_var"))
    log_likelihood = -n / 2 * (F.lit(math.log(2 * math.pi)) + F.ln(F.col("_ss") / n) + 1)
    skew, kurt = F.col("skewness"), F.col("excess_kurtosis")
    return (
        sums.where((n >= 3) & (F.col("_ss") > 0))
        .withColumns(
            {
                "aic": -2 * log_likelihood + 2 * parameters,
                "durbin_watson": F.col("_dd") / F.col("_ss"),
                "jarque_bera": n / 6 * (skew * skew + kurt * kurt / 4),
                "ljung_box": n * (n + 2) * rho * rho / (n - 1),
            }
        )
        .select(
            "symbol",
            "n",
            "aic",
            "durbin_watson",
            "skewness",
            "excess_kurtosis",
            "jarque_bera",
            F.exp(-F.col("jarque_bera") / 2).alias("jarque_bera_p"),
            "ljung_box",
            chi2_sf(F.col("ljung_box"), F.lit(1.0)).alias("ljung_box_p"),
        )
    )
