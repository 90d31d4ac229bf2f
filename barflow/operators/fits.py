"""Student-t maximum likelihood, fitted tails and goodness-of-fit tests."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from barflow.constants import (
    CHI_SQUARE_BINS,
    MIN_EXPECTED_COUNT,
    MIN_KS_OBSERVATIONS,
    TAIL_THRESHOLD,
)
from barflow.functions.numerics import (
    chi2_sf,
    digamma_sql,
    kolmogorov_sf,
    normal_cdf,
    normal_ppf,
    normal_sf,
    student_t_cdf,
    student_t_log_norm,
    student_t_ppf,
    trigamma_sql,
)
from barflow.operators.describe import fit_normal, histogram
from barflow.operators.returns import empirical_rank
from barflow.session import drop_path, scratch_path

# Degrees of freedom are searched in this range; at the upper end the fit is a normal one.
DF_RANGE = (0.1, 1000.0)
STEPS_PER_PASS = 2
_STATE = ("symbol", "n", "loc", "log_scale", "log_df")


# The expressions of one fitting step, as SQL text that is parsed once per step.

# Averages over the data, in terms of the standardised value z, v = df, d = v + z² and
# w = (v + 1) / d.
_AVERAGES = {
    "lq": "log1p(z * z / v)",
    "wz": "w * z",
    "wzz": "w * z * z",
    "w_curve": "w * (v - z * z) / d",
    "wz_d": "w * z / d",
    "wzz_d": "w * z * z / d",
    "zz_d": "z * z / d",
    "z_dd": "z * (z * z - 1) / (d * d)",
    "zz_dd": "z * z * (z * z - 1) / (d * d)",
}
# Digamma and trigamma differences between (v + 1) / 2 and v / 2.
_POLYGAMMA = {
    "psi": f"{digamma_sql('((v + 1) / 2)')} - {digamma_sql('(v / 2)')}",
    "psi1": f"{trigamma_sql('((v + 1) / 2)')} - {trigamma_sql('(v / 2)')}",
}
# Gradient g and negated second derivatives h of the mean log-likelihood in (loc / scale,
# ln scale, ln df); e holds the expected curvature, which serves where h is not positive.
_DERIVATIVES = {
    "g1": "wz",
    "g2": "wzz - 1",
    "g3": "v * (psi - 1 / v - lq + wzz / v) / 2",
    "h11": "w_curve",
    "h12": "2 * v * wz_d",
    "h13": "-v * z_dd",
    "h22": "2 * v * wzz_d",
    "h23": "-v * zz_dd",
    "h33": "-v * v * (psi1 / 2 + 1 / (v * v) + zz_d / v + zz_dd / v - wzz / (v * v)) / 2"
    " - v * (psi - 1 / v - lq + wzz / v) / 2",
    "e11": "(v + 1) / (v + 3)",
    "e22": "2 * v / (v + 3)",
    "e23": "-2 * v / ((v + 1) * (v + 3))",
    "e33": "v * v * (-psi1 / 4 - (v + 5) / (2 * v * (v + 1) * (v + 3)))",
}
_COFACTORS = {
    "c11": "h22 * h33 - h23 * h23",
    "c12": "h13 * h23 - h12 * h33",
    "c13": "h12 * h23 - h13 * h22",
    "c22": "h11 * h33 - h13 * h13",
    "c23": "h12 * h13 - h11 * h23",
    "c33": "h11 * h22 - h12 * h12",
    "e_det": "e22 * e33 - e23 * e23",
}
_DETERMINANT = {
    "det": "h11 * c11 + h12 * c12 + h13 * c13",
}
# A Newton step where the curvature is positive definite, else a scoring step.
_STEPS = {
    "step1": ("(c11 * g1 + c12 * g2 + c13 * g3) / det", "g1 / e11"),
    "step2": ("(c12 * g1 + c22 * g2 + c23 * g3) / det", "(e33 * g2 - e23 * g3) / e_det"),
    "step3": ("(c13 * g1 + c23 * g2 + c33 * g3) / det", "(e22 * g3 - e23 * g2) / e_det"),
}


def _columns(expressions: dict[str, str]) -> dict[str, Column]:
    return {name: F.expr(text) for name, text in expressions.items()}


def _fit_step(data: DataFrame, params: DataFrame, value: str) -> DataFrame:
    """One step for every symbol: a join with the parameters, one aggregation, a projection."""
    steps = {
        name: f"if(h11 > 0 and c33 > 0 and det > 0, {newton}, {scoring})"
        for name, (newton, scoring) in _STEPS.items()
    }
    low, high = (repr(math.log(x)) + "D" for x in DF_RANGE)
    standardised = {"v": "exp(log_df)", "z": f"({value} - loc) / exp(log_scale)"}
    return (
        data.join(params, "symbol")
        .withColumns(_columns(standardised))
        .withColumns(_columns({"d": "v + z * z", "w": "(v + 1) / (v + z * z)"}))
        .groupBy(*_STATE)
        .agg(*[F.expr(f"avg({text})").alias(name) for name, text in _AVERAGES.items()])
        .withColumn("v", F.expr("exp(log_df)"))
        .withColumns(_columns(_POLYGAMMA))
        .withColumns(_columns(_DERIVATIVES))
        .withColumns(_columns(_COFACTORS))
        .withColumns(_columns(_DETERMINANT))
        .withColumns(_columns(steps))
        .withColumn("broken", F.expr("isnan(step1) or isnan(step2) or isnan(step3)"))
        # a step that is not a number moves nothing and ends the symbol's search
        .withColumns(_columns({s: f"if(broken, 0D, greatest(-1D, least(1D, {s})))" for s in steps}))
        .withColumn("new_df", F.expr(f"greatest({low}, least({high}, log_df + step3))"))
        .selectExpr(
            "symbol",
            "n",
            "loc + exp(log_scale) * step1 AS loc",
            "log_scale + step2 AS log_scale",
            "new_df AS log_df",
            "if(broken, double('NaN'), greatest(abs(step1), abs(step2), abs(new_df - log_df))) AS move",
        )
    )


def _written(df: DataFrame, name: str, paths: list[str]) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, without its lineage. Notes the path."""
    paths.append(scratch_path(df.sparkSession, name))
    df.write.parquet(paths[-1])
    return df.sparkSession.read.schema(df.schema).parquet(paths[-1])


def student_t_report(
    df: DataFrame, value: str = "ret", tolerance: float = 1e-5, max_steps: int = 60
) -> DataFrame:
    """Maximum-likelihood ``df, loc, scale`` per symbol with what became of the search.

    Newton's method for all symbols at once: a step is one partially aggregated pass over the
    series, and the parameters stay a table. Series and parameters are written to the shared
    folder, so that each step runs once and a lost executor costs two steps at most; all but the
    result is deleted at the end. A symbol leaves the loop as soon as its move is below the tolerance;
    after a Newton step of that size the remaining error is of the order of its square. This is the
    one operator that starts jobs itself, because the number of passes depends on the data.

    ``status``: ``converged``; ``too_few`` (under three observations); ``no_spread``; ``degenerate`` (one
    value makes up more than half of the series: the likelihood has no maximum); ``failed`` (a step was
    not a number); ``max_steps`` (still moving). Parameters are null where no search began. ``at_bound``
    marks degrees of freedom at an end of ``DF_RANGE``.
    """
    spark, paths = df.sparkSession, []
    data = _written(df.where(F.col(value).isNotNull()).select("symbol", value), "t-series", paths)
    most = data.groupBy("symbol", value).agg(F.count(F.lit(1)).alias("same"))
    most = most.groupBy("symbol").agg(F.max("same").alias("same"))
    moments = data.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("n"), F.avg(value).alias("loc"), F.stddev_samp(value).alias("sd")
    )
    reason = (
        F.when(F.col("n") < 3, "too_few")
        .when(F.col("sd") == 0, "no_spread")
        .when(2 * F.col("same") > F.col("n"), "degenerate")
    )
    begun = _written(
        moments.join(most, "symbol").select(
            "symbol", "n", "loc", F.ln(F.nullif(F.col("sd"), F.lit(0.0)) * math.sqrt(0.5)).alias("log_scale"),
            F.lit(math.log(4.0)).alias("log_df"), reason.alias("status"),
        ),
        "t-start", paths,
    )
    none = F.lit(None).cast("double")
    done = [
        begun.where("status IS NOT NULL").select(
            "symbol", "n", none.alias("loc"), none.alias("log_scale"), none.alias("log_df"), "status", F.lit(0).alias("steps")
        )
    ]
    active = begun.where("status IS NULL").drop("status")
    moving = ~F.isnan("move") & (F.col("move") >= tolerance)
    steps = 0
    while steps < max_steps:
        seen, stepped = Observation(), active
        for _ in range(STEPS_PER_PASS):
            stepped = _fit_step(data, stepped.select(*_STATE), value)
        steps += STEPS_PER_PASS
        now = _written(stepped.observe(seen, F.count_if(moving).alias("left")), "t-params", paths)
        status = F.when(F.isnan("move"), "failed").otherwise("converged")
        done.append(now.where(~moving).select(*_STATE, status.alias("status"), F.lit(steps).alias("steps")))
        active = now.where(moving)
        if not seen.get["left"]:
            break
    done.append(active.select(*_STATE, F.lit("max_steps").alias("status"), F.lit(steps).alias("steps")))
    edge = F.least(*[F.abs(F.col("log_df") - math.log(x)) for x in DF_RANGE]) < 1e-9
    report = reduce(DataFrame.unionByName, done).select(
        "symbol", "n", F.exp("log_df").alias("df"), "loc", F.exp("log_scale").alias("scale"), "status", "steps",
        F.coalesce(edge, F.lit(False)).alias("at_bound"),
    )
    result = _written(report, "t-fits", [])
    for path in paths:
        drop_path(spark, path)
    return result


def fit_student_t(
    df: DataFrame, value: str = "ret", tolerance: float = 1e-5, max_steps: int = 60
) -> DataFrame:
    """``symbol, n, df, loc, scale`` of the symbols whose search converged; see ``student_t_report``."""
    report = student_t_report(df, value, tolerance, max_steps)
    return report.where("status = 'converged'").select("symbol", "n", "df", "loc", "scale")


def fit_params(df: DataFrame, value: str = "ret") -> DataFrame:
    """Normal and Student-t parameters side by side, one row per symbol."""
    t = fit_student_t(df, value).drop("n")
    return (
        fit_normal(df, value)
        .join(t, "symbol")
        .withColumn("t_log_norm", student_t_log_norm(F.col("df"), F.col("scale")))
    )


def tail_prob_normal(params: DataFrame, threshold: float = TAIL_THRESHOLD) -> DataFrame:
    """Two-sided tail beyond ``threshold`` under the normal fit."""
    upper = (F.lit(threshold) - F.col("mu")) / F.col("sigma")
    lower = (F.lit(-threshold) - F.col("mu")) / F.col("sigma")
    return params.withColumn("tail_normal", normal_sf(upper) + normal_cdf(lower))


def tail_prob_t(params: DataFrame, threshold: float = TAIL_THRESHOLD) -> DataFrame:
    """Two-sided tail beyond ``threshold`` under the Student-t fit."""
    upper = (F.lit(threshold) - F.col("loc")) / F.col("scale")
    lower = (F.lit(-threshold) - F.col("loc")) / F.col("scale")
    tail = student_t_cdf(-upper, F.col("df")) + student_t_cdf(lower, F.col("df"))
    return params.withColumn("tail_t", tail)


def _ks_distance(ranked: DataFrame, cdf: Column) -> DataFrame:
    gap = F.greatest(
        F.col("i") / F.col("n") - F.col("_cdf"), F.col("_cdf") - (F.col("i") - 1) / F.col("n")
    )
    return (
        ranked.withColumn("_cdf", cdf)
        .groupBy("symbol")
        .agg(F.max(gap).alias("d"), F.max("n").alias("n"))
    )


def ks_normal(df: DataFrame, params: DataFrame, value: str = "ret") -> DataFrame:
    """Kolmogorov–Smirnov distance and p-value against the fitted normal, for n ≥ 10."""
    ranked = empirical_rank(df, value).where(F.col("n") >= MIN_KS_OBSERVATIONS)
    z = (F.col(value) - F.col("mu")) / F.col("sigma")
    fitted = ranked.join(params.select("symbol", "mu", "sigma"), "symbol")
    return _ks_distance(fitted, normal_cdf(z)).withColumn(
        "p_value", kolmogorov_sf(F.col("d"), F.col("n"))
    )


def ks_student_t(df: DataFrame, params: DataFrame, value: str = "ret") -> DataFrame:
    """Kolmogorov–Smirnov distance and p-value against the fitted Student t, for n ≥ 10."""
    ranked = empirical_rank(df, value).where(F.col("n") >= MIN_KS_OBSERVATIONS)
    z = (F.col(value) - F.col("loc")) / F.col("scale")
    fitted = ranked.join(params.select("symbol", "df", "loc", "scale"), "symbol")
    return _ks_distance(fitted, student_t_cdf(z, F.col("df"))).withColumn(
        "p_value", kolmogorov_sf(F.col("d"), F.col("n"))
    )


def ks_test(df: DataFrame, params: DataFrame, value: str = "ret", digits: int | None = None) -> DataFrame:
    """Both Kolmogorov–Smirnov tests, one row per symbol and distribution.

    With ``digits`` distances are reported in so many decimals and the p-value is that of the reported distance.
    """
    normal = ks_normal(df, params, value).withColumn("distribution", F.lit("normal"))
    t = ks_student_t(df, params, value).withColumn("distribution", F.lit("student_t"))
    tests = normal.unionByName(t).select("symbol", "distribution", "n", "d", "p_value")
    if digits is None:
        return tests
    reported = tests.withColumn("d", F.round("d", digits))
    return reported.withColumn("p_value", kolmogorov_sf(F.col("d"), F.col("n")))


def chi_square_bins(df: DataFrame, bins: int = CHI_SQUARE_BINS, value: str = "ret") -> DataFrame:
    """Observed and expected counts of the normal fit over equal-width bins.

    Symbols with fewer than two observations per bin have no rows.
    """
    counted = histogram(df, bins, value).where(F.col("n") >= 2 * bins)
    params = fit_normal(df, value).select("symbol", "mu", "sigma")

    def below(edge: str) -> Column:
        return normal_cdf((F.col(edge) - F.col("mu")) / F.col("sigma"))

    return counted.join(params, "symbol").select(
        "symbol",
        "bin",
        "lower",
        "upper",
        "observed",
        (F.col("n") * (below("upper") - below("lower"))).alias("expected"),
    )


def chi_square_normal(df: DataFrame, bins: int = CHI_SQUARE_BINS, value: str = "ret") -> DataFrame:
    """χ² statistic and p-value of the normal fit.

    Bins expecting fewer than five observations are left out; a symbol needs more than three
    of the others, so that a degree of freedom is left.
    """
    difference = F.col("observed") - F.col("expected")
    return (
        chi_square_bins(df, bins, value)
        .where(F.col("expected") >= MIN_EXPECTED_COUNT)
        .groupBy("symbol")
        .agg(
            F.count(F.lit(1)).alias("bins_used"),
            F.sum(difference * difference / F.col("expected")).alias("chi2"),
        )
        .where(F.col("bins_used") > 3)
        .withColumn("dof", F.col("bins_used") - 3)
        .withColumn("p_value", chi2_sf(F.col("chi2"), F.col("dof").cast("double")))
    )


def normal_order_position() -> Column:
    """Filliben's estimate of the median of each order statistic."""
    i, n = F.col("i"), F.col("n")
    top = F.pow(F.lit(0.5), 1 / n)
    return (
        F.when(i == n, top).when(i == 1, 1 - top).otherwise((i - 0.3175) / (n + 0.365))
    )


def qq_normal(df: DataFrame, params: DataFrame, value: str = "ret") -> DataFrame:
    """Sorted values against normal quantiles at Filliben's positions, for n ≥ 10."""
    ranked = empirical_rank(df, value).where(F.col("n") >= MIN_KS_OBSERVATIONS)
    return (
        ranked.withColumn("_p", normal_order_position())
        .join(params.select("symbol", "mu", "sigma"), "symbol")
        .select(
            "symbol",
            "i",
            F.col("_p").alias("position"),
            (F.col("mu") + F.col("sigma") * normal_ppf(F.col("_p"))).alias("theoretical"),
            F.col(value).alias("empirical"),
        )
    )


def qq_student_t(df: DataFrame, params: DataFrame, value: str = "ret") -> DataFrame:
    """Sorted values against Student-t quantiles at ``(i − 0.5) / n``, for n ≥ 10."""
    ranked = empirical_rank(df, value).where(F.col("n") >= MIN_KS_OBSERVATIONS)
    quantile = F.col("loc") + F.col("scale") * student_t_ppf(F.col("position"), F.col("df"))
    return ranked.join(params.select("symbol", "df", "loc", "scale"), "symbol").select(
        "symbol", "i", "position", quantile.alias("theoretical"), F.col(value).alias("empirical")
    )
