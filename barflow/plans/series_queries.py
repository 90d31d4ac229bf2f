"""Queries over daily return series: moments, fits, tests, regressions, forecasts, risk."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from barflow.functions.recursive import RecursiveLeastSquares
from barflow.operators.describe import (
    clip_central,
    density_grid,
    describe_returns,
    fit_normal,
    histogram,
    tail_prob_empirical,
)
from barflow.operators.fits import (
    chi_square_bins,
    chi_square_normal,
    fit_params,
    fit_student_t,
    student_t_report,
    ks_normal,
    ks_student_t,
    ks_test,
    qq_normal,
    qq_student_t,
    tail_prob_normal,
    tail_prob_t,
)
from barflow.operators.forecast import (
    ar1_walk_forward,
    forecast_errors,
    forecast_next_day,
    forecast_period,
    series_coefficients,
    series_forecast,
)
from barflow.operators.regression import (
    ar1_fit,
    ar1_fitted,
    ar1_forecast,
    residual_diagnostics,
)
from barflow.operators.returns import (
    cumulative_path,
    empirical_rank,
    lag_design,
    log_returns,
    simple_returns,
)
from barflow.operators.risk import scenario_paths, scenario_risk, tail_risk
from barflow.plans.inputs import CLOSES, RETURNS, closes, returns, rounded, text_dates
from barflow.plans.registry import query

_DS = "strftime(ds, '%Y-%m-%d') AS ds"


def _shown(df, digits, *columns):
    return rounded(text_dates(df, "ds"), digits, *columns)


# --- returns ----------------------------------------------------------------


@query(f"WITH {RETURNS} SELECT symbol, {_DS}, round(ret, 9) AS ret FROM returns")
def log_return_series(spark, sf_dir):
    return _shown(log_returns(closes(spark, sf_dir)), 9, "ret")


@query(f"""WITH {RETURNS} SELECT symbol, {_DS}, round(ratio - 1, 9) AS ret FROM ratios
WHERE ratio IS NOT NULL""")
def simple_return_series(spark, sf_dir):
    return _shown(simple_returns(closes(spark, sf_dir)), 9, "ret")


_PAIRS = f"""{RETURNS}, lagged AS (
  SELECT symbol, ds, ret, lag(ret) OVER (PARTITION BY symbol ORDER BY ds) AS prev FROM returns),
pairs AS (SELECT * FROM lagged WHERE prev IS NOT NULL)"""


@query(f"WITH {_PAIRS} SELECT symbol, {_DS}, round(ret, 9) AS ret, round(prev, 9) AS lag1 FROM pairs")
def lag_pairs(spark, sf_dir):
    return _shown(lag_design(returns(spark, sf_dir)), 9, "ret", "lag1")


@query(f"""WITH {RETURNS}, c AS (
  SELECT symbol, ds, sum(ret) OVER (PARTITION BY symbol ORDER BY ds) AS total FROM returns)
SELECT symbol, {_DS}, round(total, 8) AS cum_log_ret, round(100 * exp(total), 6) AS price FROM c""")
def price_paths(spark, sf_dir):
    path = cumulative_path(returns(spark, sf_dir), start=100.0).drop("ret")
    return rounded(_shown(path, 8, "cum_log_ret"), 6, "price")


_RANKED = f"""{RETURNS}, ranked AS (
  SELECT symbol, ds, ret, row_number() OVER (PARTITION BY symbol ORDER BY ret, ds) AS i,
         count(*) OVER (PARTITION BY symbol) AS n FROM returns)"""


@query(f"""WITH {_RANKED} SELECT symbol, {_DS}, i, n, round((i - 0.5) / n, 9) AS position
FROM ranked""")
def qq_positions(spark, sf_dir):
    ranked = empirical_rank(returns(spark, sf_dir)).drop("ret")
    return _shown(ranked.withColumn("i", F.col("i").cast("bigint")), 9, "position")


# --- moments and bins -------------------------------------------------------


@query(f"""WITH {RETURNS}, s AS (
  SELECT symbol, count(*) AS n, avg(ret) AS mean, var_samp(ret) AS variance,
         stddev_samp(ret) AS std, skewness(ret) AS skewness, kurtosis(ret) AS kurtosis
  FROM returns GROUP BY 1 HAVING count(*) >= 2)
SELECT symbol, n, round(mean, 8) AS mean, round(variance, 8) AS variance, round(std, 8) AS std,
       round(skewness, 7) AS skewness, round(kurtosis, 7) AS kurtosis,
       round(mean - 1.96 * std / sqrt(n), 8) AS ci_lower,
       round(mean + 1.96 * std / sqrt(n), 8) AS ci_upper FROM s""")
def describe_return_series(spark, sf_dir):
    s = describe_returns(returns(spark, sf_dir))
    s = rounded(s, 8, "mean", "variance", "std", "ci_lower", "ci_upper")
    return rounded(s, 7, "skewness", "kurtosis")


@query(f"""WITH {RETURNS} SELECT symbol, count(*) AS n, round(avg(ret), 8) AS mu,
       round(stddev_samp(ret), 8) AS sigma FROM returns GROUP BY 1""")
def normal_fits(spark, sf_dir):
    return rounded(fit_normal(returns(spark, sf_dir)), 8, "mu", "sigma")


@query(f"""WITH {RETURNS} SELECT symbol,
       round(avg(CASE WHEN abs(ret) > 0.1 THEN 1.0::DOUBLE ELSE 0.0 END), 9) AS tail_empirical
FROM returns GROUP BY 1""")
def tail_prob(spark, sf_dir):
    return rounded(tail_prob_empirical(returns(spark, sf_dir)), 9, "tail_empirical")


def _histogram_sql(source: str, bins: int) -> str:
    return f"""edges AS (
  SELECT symbol, count(*) AS n, min(ret) AS first_edge, (max(ret) - min(ret)) / {bins} AS width
  FROM {source} GROUP BY 1), binned AS (
  SELECT symbol, least(CAST(floor((ret - first_edge) / width) AS INTEGER), {bins} - 1) AS bin,
         count(*) AS c FROM {source} JOIN edges USING (symbol) GROUP BY 1, 2), hist AS (
  SELECT e.symbol, CAST(g.bin AS INTEGER) AS bin, n, width, first_edge + g.bin * width AS lower,
         first_edge + (g.bin + 1) * width AS upper, coalesce(c, 0) AS observed
  FROM edges e CROSS JOIN range(0, {bins}) g(bin) LEFT JOIN binned b
    ON b.symbol = e.symbol AND b.bin = g.bin)"""


_HISTOGRAM_COLUMNS = """symbol, bin, n, round(lower, 8) AS lower, round(upper, 8) AS upper, observed,
       round(observed / (n * width), 8) AS density"""


@query(f"""WITH {RETURNS}, {_histogram_sql("returns", 80)} SELECT {_HISTOGRAM_COLUMNS} FROM hist""")
def return_histogram(spark, sf_dir):
    return rounded(histogram(returns(spark, sf_dir)), 8, "lower", "upper", "density")


@query(f"""WITH {RETURNS}, q AS (
  SELECT symbol, quantile_cont(ret, 0.005::DOUBLE) AS lo, quantile_cont(ret, 0.995::DOUBLE) AS hi
  FROM returns GROUP BY 1), clipped AS (
  SELECT r.* FROM returns r JOIN q USING (symbol) WHERE ret BETWEEN lo AND hi),
{_histogram_sql("clipped", 80)} SELECT {_HISTOGRAM_COLUMNS} FROM hist""")
def return_histogram_central(spark, sf_dir):
    central = clip_central(returns(spark, sf_dir))
    return rounded(histogram(central), 8, "lower", "upper", "density")


# --- distribution functions in SQL ------------------------------------------


def _phi_sql(z: str) -> str:
    """Normal CDF by its odd power series, for |z| up to 7."""
    c = f"greatest(-7.0::DOUBLE, least(7.0::DOUBLE, {z}))"
    series = "1.0::DOUBLE"
    for k in range(90, 0, -1):
        series = f"1 + v.y2 / {2 * k + 1} * ({series})"
    return (
        f"(SELECT 0.5 + v.y * exp(-v.y2 / 2) / sqrt(2 * pi()) * ({series}) "
        f"FROM (SELECT {c} AS y, ({c}) * ({c}) AS y2) v)"
    )


def _t_cdf_sql(t: str, df: str, nodes: int = 60) -> str:
    """Student-t CDF by Gauss–Legendre quadrature over the angle."""
    x, w = np.polynomial.legendre.leggauss(nodes)
    terms = " + ".join(
        f"{float(wi) / 2!r} * pow(cos(v.th * {(float(xi) + 1) / 2!r}), v.nu - 1)" for xi, wi in zip(x, w)
    )
    return (
        "(SELECT 0.5 + sign(v.t) * v.th * exp(lgamma((v.nu + 1) / 2) - lgamma(v.nu / 2)) "
        f"/ sqrt(pi()) * ({terms}) "
        f"FROM (SELECT {t} AS t, {df} AS nu, atan(abs({t}) / sqrt({df})) AS th) v)"
    )


_FIT = f"""{RETURNS}, nfit AS (
  SELECT symbol, count(*) AS n, avg(ret) AS mu, stddev_samp(ret) AS sigma FROM returns GROUP BY 1)"""

_CHI = f"""{_FIT}, {_histogram_sql("returns", 40)}, edge_cdf AS (
  SELECT symbol, bin, lower, upper, observed, h.n, (lower - mu) / sigma AS za,
         (upper - mu) / sigma AS zb FROM hist h JOIN nfit USING (symbol) WHERE h.n >= 80), expected AS (
  SELECT symbol, bin, lower, upper, observed, n * ({_phi_sql("zb")} - {_phi_sql("za")}) AS expected
  FROM edge_cdf)"""


@query(f"""WITH {_CHI} SELECT symbol, bin, round(lower, 8) AS lower, round(upper, 8) AS upper, observed,
       round(expected, 6) AS expected FROM expected""")
def chi_square_bin_table(spark, sf_dir):
    table = chi_square_bins(returns(spark, sf_dir))
    return rounded(rounded(table, 8, "lower", "upper"), 6, "expected")


@query(f"""WITH {_CHI}, stat AS (
  SELECT symbol, count(*) AS k, count(*) - 3 AS dof, sum((observed - expected) ** 2 / expected) / 2 AS h
  FROM expected WHERE expected >= 5 GROUP BY 1 HAVING count(*) > 3), root AS (
  SELECT *, -sqrt(2 * h) AS z FROM stat)
SELECT symbol, k AS bins_used, dof, round(2 * h, 5) AS chi2, round(CASE
  WHEN dof % 2 = 0 THEN list_sum(list_transform(range(0, dof // 2), lambda j: exp(j * ln(h) - h - lgamma(j + 1))))
  ELSE 2 * {_phi_sql("z")} + coalesce(list_sum(list_transform(range(1, (dof + 1) // 2),
         lambda j: exp((j - 0.5) * ln(h) - h - lgamma(j + 0.5)))), 0) END, 7) AS p_value
FROM root""")
def chi_square_test(spark, sf_dir):
    return rounded(rounded(chi_square_normal(returns(spark, sf_dir)), 5, "chi2"), 7, "p_value")


# --- Student-t fit ----------------------------------------------------------


def _digamma_sql(x: str) -> str:
    y = f"({x} + 10)"
    shift = " ".join(f"- 1 / ({x} + {j})" for j in range(10))
    return (
        f"(ln({y}) - 1 / (2 * {y}) - 1 / (12 * pow({y}, 2)) + 1 / (120 * pow({y}, 4)) "
        f"- 1 / (252 * pow({y}, 6)) + 1 / (240 * pow({y}, 8)) - 1 / (132 * pow({y}, 10)) {shift})"
    )


# Expectation–maximisation with a score step for the degrees of freedom: slower than the scoring
# used by the operator, but with the same fixed point.
_T_FIT = f"""{RETURNS}, start AS (
  SELECT symbol, avg(ret) AS loc, ln(stddev_samp(ret) * sqrt(0.5)) AS ls, ln(4.0::DOUBLE) AS lv
  FROM returns GROUP BY 1), steps AS (
  SELECT 0 AS k, symbol, loc, ls, lv FROM start
  UNION ALL
  SELECT k + 1, symbol, swx / sw, ln(sqrt(greatest(swxx / n - pow(swx, 2) / (n * sw), 1e-300))),
         greatest(ln(0.1), least(ln(1000.0), lv + greatest(-0.5, least(0.5, nu *
           ({_digamma_sql("((nu + 1) / 2)")} - {_digamma_sql("(nu / 2)")} - 1 / nu - mlq + mwzz / nu)))))
  FROM (
    SELECT s.k, s.symbol, any_value(s.lv) AS lv, exp(any_value(s.lv)) AS nu, count(*) AS n,
           sum(w) AS sw, sum(w * ret) AS swx, sum(w * ret * ret) AS swxx,
           avg(w * z * z) AS mwzz, avg(ln(1 + z * z / exp(s.lv))) AS mlq
    FROM (SELECT s.k, s.symbol, s.lv, r.ret, (r.ret - s.loc) / exp(s.ls) AS z,
                 (exp(s.lv) + 1) / (exp(s.lv) + pow((r.ret - s.loc) / exp(s.ls), 2)) AS w
          FROM steps s JOIN returns r ON r.symbol = s.symbol WHERE s.k < 1000) s
    GROUP BY s.k, s.symbol)), tfit AS (
  SELECT symbol, loc, exp(ls) AS scale, exp(lv) AS df FROM steps WHERE k = 1000)"""


@query(f"""WITH RECURSIVE {_T_FIT}
SELECT symbol, (SELECT count(*) FROM returns r WHERE r.symbol = t.symbol) AS n,
       round(df, 5) AS df, round(loc, 6) AS loc, round(scale, 6) AS scale FROM tfit t""")
def student_t_fits(spark, sf_dir):
    fit = fit_student_t(returns(spark, sf_dir))
    return rounded(rounded(fit, 6, "loc", "scale"), 5, "df")


@query(f"""WITH {RETURNS}, series AS (
  SELECT symbol, ret FROM returns UNION ALL
  SELECT symbol || ' flat', CASE WHEN month(ds) > 2 THEN 0 ELSE ret END FROM returns UNION ALL
  SELECT symbol || ' once', 0 FROM returns UNION ALL
  SELECT symbol || ' two', ret FROM returns WHERE ret IN (
    (SELECT max(ret) FROM returns), (SELECT min(ret) FROM returns))), same AS (
  SELECT symbol, ret, count(*) AS k FROM series GROUP BY 1, 2), per AS (
  SELECT symbol, sum(k)::BIGINT AS n, max(k) AS top, count(*) AS different FROM same GROUP BY 1)
SELECT symbol, n, CASE WHEN n < 3 THEN 'too_few' WHEN different = 1 THEN 'no_spread'
                       WHEN 2 * top > n THEN 'degenerate' ELSE 'converged' END AS status FROM per""")
def student_t_status(spark, sf_dir):
    """What becomes of the search: on the series, and on series without a likelihood maximum."""
    r = returns(spark, sf_dir).select("symbol", "ds", "ret")
    named = lambda tag: F.concat("symbol", F.lit(tag)).alias("symbol")
    flat = F.when(F.month("ds") > 2, 0.0).otherwise(F.col("ret")).alias("ret")
    ends = r.agg(F.array(F.max("ret"), F.min("ret")).alias("ends")).select(F.explode("ends").alias("ret"))
    series = (
        r.select("symbol", "ret")
        .unionByName(r.select(named(" flat"), flat))
        .unionByName(r.select(named(" once"), F.lit(0.0).alias("ret")))
        .unionByName(r.join(ends, "ret").select(named(" two"), "ret"))
    )
    return student_t_report(series).select("symbol", "n", "status")


@query(f"""WITH RECURSIVE {_T_FIT}, nfit AS (
  SELECT symbol, avg(ret) AS mu, stddev_samp(ret) AS sigma FROM returns GROUP BY 1), z AS (
  SELECT symbol, df, (0.1 - mu) / sigma AS a, (-0.1 - mu) / sigma AS b,
         (0.1 - loc) / scale AS c, (-0.1 - loc) / scale AS d FROM nfit JOIN tfit USING (symbol))
SELECT symbol, round(1 - {_phi_sql("a")} + {_phi_sql("b")}, 7) AS tail_normal,
       round(1 - {_t_cdf_sql("c", "df")} + {_t_cdf_sql("d", "df")}, 6) AS tail_t FROM z""")
def tail_prob_models(spark, sf_dir):
    tails = tail_prob_t(tail_prob_normal(fit_params(returns(spark, sf_dir))))
    shown = tails.select("symbol", "tail_normal", "tail_t")
    return rounded(rounded(shown, 7, "tail_normal"), 6, "tail_t")


@query(f"""WITH {_RANKED}, nfit AS (
  SELECT symbol, avg(ret) AS mu, stddev_samp(ret) AS sigma FROM returns GROUP BY 1), z AS (
  SELECT symbol, i, r.n, (ret - mu) / sigma AS z FROM ranked r JOIN nfit USING (symbol)), c AS (
  SELECT symbol, i, n, {_phi_sql("z")} AS p FROM z)
SELECT symbol, max(n) AS n, round(max(greatest(i / n - p, p - (i - 1) / n)), 7) AS d
FROM c GROUP BY 1""")
def ks_normal_distance(spark, sf_dir):
    r = returns(spark, sf_dir)
    return rounded(ks_normal(r, fit_normal(r)).drop("p_value"), 7, "d")


@query(f"""WITH RECURSIVE {_T_FIT}, ranked AS (
  SELECT symbol, ret, row_number() OVER (PARTITION BY symbol ORDER BY ret, ds) AS i,
         count(*) OVER (PARTITION BY symbol) AS n FROM returns), z AS (
  SELECT symbol, i, n, df, (ret - loc) / scale AS z FROM ranked JOIN tfit USING (symbol)), c AS (
  SELECT symbol, i, n, {_t_cdf_sql("z", "df")} AS p FROM z)
SELECT symbol, max(n) AS n, round(max(greatest(i / n - p, p - (i - 1) / n)), 5) AS d
FROM c GROUP BY 1""")
def ks_student_t_distance(spark, sf_dir):
    r = returns(spark, sf_dir)
    return rounded(ks_student_t(r, fit_params(r)).drop("p_value"), 5, "d")


# The ordered sample as a Poisson path between two lines, followed from each time at which a
# line passes a whole number to the next.
_KS = f"""{_T_FIT}, nfit AS (
  SELECT symbol, avg(ret) AS mu, stddev_samp(ret) AS sigma FROM returns GROUP BY 1), ranked AS (
  SELECT symbol, ret, row_number() OVER (PARTITION BY symbol ORDER BY ret, ds) AS i,
         count(*) OVER (PARTITION BY symbol) AS n FROM returns), cdfs AS (
  SELECT symbol, 'normal' AS distribution, i, n, {_phi_sql("z")} AS p
  FROM (SELECT symbol, i, n, (ret - mu) / sigma AS z FROM ranked JOIN nfit USING (symbol))
  UNION ALL
  SELECT symbol, 'student_t', i, n, {_t_cdf_sql("z", "df")}
  FROM (SELECT symbol, i, n, df, (ret - loc) / scale AS z FROM ranked JOIN tfit USING (symbol))), tests AS (
  SELECT symbol, distribution, max(n) AS n, round(max(greatest(i / n - p, p - (i - 1) / n)), 5) AS d
  FROM cdfs GROUP BY 1, 2), times AS (
  SELECT symbol, distribution, i - n * d AS tau, 0 AS low, i - 1 AS high FROM tests, range(0, 10000) r(i)
  WHERE i <= n AND i - n * d > 0
  UNION ALL
  SELECT symbol, distribution, i + n * d, i + 1, n FROM tests, range(0, 10000) r(i) WHERE i + n * d < n
  UNION ALL
  SELECT symbol, distribution, n::DOUBLE, n, n FROM tests), gaps AS MATERIALIZED (
  SELECT symbol, distribution, low, high, k, exp(-gap) * pow(gap, k) / exp(lgamma(k + 1)) AS w, j
  FROM (SELECT *, tau - lag(tau, 1, 0) OVER s AS gap, row_number() OVER s AS j FROM times
        WINDOW s AS (PARTITION BY symbol, distribution ORDER BY tau)), range(0, 24) r(k)), paths AS (
  SELECT symbol, distribution, 0::BIGINT AS j, 0::BIGINT AS c, 1.0::DOUBLE AS p FROM tests
  UNION ALL
  SELECT s.symbol, s.distribution, s.j + 1, s.c + g.k, sum(s.p * g.w)
  FROM paths s JOIN gaps g ON g.symbol = s.symbol AND g.distribution = s.distribution AND g.j = s.j + 1
  WHERE s.c + g.k BETWEEN g.low AND g.high GROUP BY 1, 2, 3, 4), ends AS (
  SELECT symbol, distribution, arg_max(p, j) AS p, max(j) AS j FROM paths GROUP BY 1, 2)"""


@query(f"""WITH RECURSIVE {_KS} SELECT symbol, distribution, n, d,
       round(1 - p * exp(n - n * ln(n) + lgamma(n + 1)), 8) AS p_value FROM tests JOIN ends USING (symbol, distribution)""")
def ks_tests(spark, sf_dir):
    r = returns(spark, sf_dir)
    return rounded(ks_test(r, fit_params(r), digits=5), 8, "p_value")


# Quantiles in SQL: Acklam's rational approximation and one Newton step on the power series.
_QUANTILE_GUESS = """CASE
  WHEN p < 0.02425 OR p > 0.97575 THEN sign(p - 0.5) * -1 * (((((
    -7.784894002430293e-03 * t - 3.223964580411365e-01) * t - 2.400758277161838e+00) * t
    - 2.549732539343734e+00) * t + 4.374664141464968e+00) * t + 2.938163982698783e+00) / ((((
    7.784695709041462e-03 * t + 3.224671290700398e-01) * t + 2.445134137142996e+00) * t
    + 3.754408661907416e+00) * t + 1)
  ELSE (((((-3.969683028665376e+01 * r + 2.209460984245205e+02) * r - 2.759285104469687e+02) * r
    + 1.383577518672690e+02) * r - 3.066479806614716e+01) * r + 2.506628277459239e+00) * (p - 0.5) / (((((
    -5.447609879822406e+01 * r + 1.615858368580409e+02) * r - 1.556989798598866e+02) * r
    + 6.680131188771972e+01) * r - 1.328068155288572e+01) * r + 1) END"""


@query(f"""WITH {_RANKED}, nfit AS (
  SELECT symbol, avg(ret) AS mu, stddev_samp(ret) AS sigma FROM returns GROUP BY 1), pos AS (
  SELECT symbol, i, ret, mu, sigma, CASE WHEN i = n THEN pow(0.5, 1.0 / n) WHEN i = 1 THEN 1 - pow(0.5, 1.0 / n)
         ELSE (i - 0.3175::DOUBLE) / (n + 0.365::DOUBLE) END AS p
  FROM ranked JOIN nfit USING (symbol) WHERE n >= 10), aux AS (
  SELECT *, sqrt(-2 * ln(least(p, 1 - p))) AS t, (p - 0.5) * (p - 0.5) AS r FROM pos), guess AS (
  SELECT *, {_QUANTILE_GUESS} AS z0 FROM aux), q AS (
  SELECT *, z0 - ({_phi_sql("z0")} - p) * sqrt(2 * pi()) * exp(z0 * z0 / 2) AS z FROM guess)
SELECT symbol, i, round(p, 9) AS position, round(mu + sigma * z, 6) AS theoretical,
       round(ret, 9) AS empirical FROM q""")
def qq_normal_points(spark, sf_dir):
    r = returns(spark, sf_dir)
    points = rounded(qq_normal(r, fit_normal(r)), 9, "position", "empirical")
    return rounded(points.withColumn("i", F.col("i").cast("bigint")), 6, "theoretical")


@query(f"""WITH RECURSIVE {_T_FIT}, ranked AS MATERIALIZED (
  SELECT r.symbol, ret, df, loc, scale, row_number() OVER w AS i, count(*) OVER (PARTITION BY r.symbol) AS n
  FROM returns r JOIN tfit t ON t.symbol = r.symbol
  WINDOW w AS (PARTITION BY r.symbol ORDER BY ret, ds)), bisect AS (
  SELECT 0 AS step, symbol, i, abs((i - 0.5) / n - 0.5) AS target, df, 0.0::DOUBLE AS lo, 64.0::DOUBLE AS hi
  FROM ranked
  UNION ALL
  SELECT step + 1, symbol, i, target, df, CASE WHEN c - 0.5 < target THEN mid ELSE lo END,
         CASE WHEN c - 0.5 < target THEN hi ELSE mid END
  FROM (SELECT *, {_t_cdf_sql("mid", "df")} AS c
        FROM (SELECT *, (lo + hi) / 2 AS mid FROM bisect WHERE step < 45)))
SELECT k.symbol, k.i, round((k.i - 0.5) / n, 9) AS position,
       round(loc + scale * sign((k.i - 0.5) / n - 0.5) * (lo + hi) / 2, 4) AS theoretical,
       round(ret, 9) AS empirical
FROM ranked k JOIN bisect b ON b.symbol = k.symbol AND b.i = k.i WHERE step = 45 AND n >= 10""")
def qq_student_t_points(spark, sf_dir):
    r = returns(spark, sf_dir)
    points = rounded(qq_student_t(r, fit_params(r)), 9, "position", "empirical")
    return rounded(points.withColumn("i", F.col("i").cast("bigint")), 4, "theoretical")


@query(f"""WITH RECURSIVE {_T_FIT}, fit AS (
  SELECT symbol, avg(ret) AS mu, stddev_samp(ret) AS sigma, min(ret) AS lo, max(ret) AS hi
  FROM returns GROUP BY 1), grid AS (
  SELECT symbol, mu, sigma, df, loc, scale, CAST(point AS INTEGER) AS point,
         lo + (hi - lo) * point / 999 AS x
  FROM fit JOIN tfit USING (symbol) CROSS JOIN range(0, 1000) g(point))
SELECT symbol, point, round(x, 8) AS x,
       round(exp(-pow((x - mu) / sigma, 2) / 2) / (sigma * sqrt(2 * pi())), 6) AS normal_density,
       round(exp(lgamma((df + 1) / 2) - lgamma(df / 2)) / (sqrt(df * pi()) * scale)
             * pow(1 + pow((x - loc) / scale, 2) / df, -(df + 1) / 2), 5) AS t_density FROM grid""")
def density_grids(spark, sf_dir):
    r = returns(spark, sf_dir)
    grid = density_grid(r, fit_params(r))
    return rounded(rounded(rounded(grid, 8, "x"), 6, "normal_density"), 5, "t_density")


# --- regressions ------------------------------------------------------------

_AR1 = f"""{_PAIRS}, fit AS (
  SELECT symbol, count(*) AS n, regr_intercept(ret, prev) AS const, regr_slope(ret, prev) AS lag1,
         regr_r2(ret, prev) AS r2, regr_sxx(ret, prev) AS sxx, regr_syy(ret, prev) AS syy,
         regr_sxy(ret, prev) AS sxy, avg(prev) AS avgx FROM pairs GROUP BY 1), errors AS (
  SELECT *, sqrt((syy - lag1 * sxy) / (n - 2) / sxx) AS se_lag,
         sqrt((syy - lag1 * sxy) / (n - 2) * (1.0 / n + avgx * avgx / sxx)) AS se_const FROM fit), ts AS (
  SELECT *, -abs(const / se_const) AS t_const, -abs(lag1 / se_lag) AS t_lag, (n - 2)::DOUBLE AS dof
  FROM errors)"""


@query(f"""WITH {_AR1} SELECT symbol, n, round(const, 8) AS const, round(lag1, 8) AS lag1,
       round(2 * {_t_cdf_sql("t_const", "dof")}, 6) AS p_const,
       round(2 * {_t_cdf_sql("t_lag", "dof")}, 6) AS p_lag1, round(r2, 8) AS r2 FROM ts""")
def ar1_fits(spark, sf_dir):
    fit = rounded(ar1_fit(returns(spark, sf_dir)), 8, "const", "lag1", "r2")
    return rounded(fit, 6, "p_const", "p_lag1")


_RESIDUALS = f"""{_AR1}, residuals AS (
  SELECT symbol, ds, ret AS actual, const + lag1 * prev AS fitted, ret - const - lag1 * prev AS e
  FROM pairs JOIN fit USING (symbol))"""


@query(f"""WITH {_RESIDUALS} SELECT symbol, {_DS}, round(actual, 8) AS actual,
       round(fitted, 8) AS fitted, round(e, 8) AS residual FROM residuals""")
def ar1_fitted_values(spark, sf_dir):
    r = returns(spark, sf_dir)
    return _shown(ar1_fitted(r, ar1_fit(r)), 8, "actual", "fitted", "residual")


@query(f"""WITH {_AR1}, newest AS (SELECT symbol, arg_max(ret, ds) AS v FROM returns GROUP BY 1)
SELECT symbol, round(const + lag1 * v, 8) AS forecast FROM fit JOIN newest USING (symbol)""")
def ar1_forecasts(spark, sf_dir):
    r = returns(spark, sf_dir)
    return rounded(ar1_forecast(r, ar1_fit(r)), 8, "forecast")


@query(f"""WITH {_RESIDUALS}, steps AS (
  SELECT symbol, e, lag(e) OVER (PARTITION BY symbol ORDER BY ds) AS b FROM residuals), m AS (
  SELECT symbol, count(*) AS n, avg(e) AS mean, sum(e * e) AS ss FROM residuals GROUP BY 1), s AS (
  SELECT symbol, any_value(n) AS n, any_value(ss) AS ss, sum((e - b) ** 2) / any_value(ss) AS dw,
         sum((e - mean) * (b - mean)) / sum((e - mean) ** 2) AS rho,
         avg((e - mean) ** 3) / pow(avg((e - mean) ** 2), 1.5) AS g1,
         avg((e - mean) ** 4) / pow(avg((e - mean) ** 2), 2) - 3 AS g2
  FROM steps JOIN m USING (symbol) GROUP BY 1)
SELECT symbol, n, round(n * (ln(2 * pi()) + ln(ss / n) + 1) + 4, 6) AS aic,
       round(dw, 8) AS durbin_watson, round(g1, 7) AS skewness, round(g2, 7) AS excess_kurtosis,
       round(n / 6.0 * (g1 * g1 + g2 * g2 / 4), 5) AS jarque_bera,
       round(exp(-n / 12.0 * (g1 * g1 + g2 * g2 / 4)), 6) AS jarque_bera_p,
       round(n * (n + 2) * rho * rho / (n - 1), 6) AS ljung_box,
       round(2 * (1 - {_phi_sql("sqrt(n * (n + 2) * rho * rho / (n - 1))")}), 6) AS ljung_box_p FROM s""")
def residual_diagnostic_table(spark, sf_dir):
    r = returns(spark, sf_dir)
    d = residual_diagnostics(ar1_fitted(r, ar1_fit(r)))
    d = rounded(d, 6, "aic", "ljung_box", "jarque_bera_p", "ljung_box_p")
    d = rounded(rounded(d, 8, "durbin_watson"), 7, "skewness", "excess_kurtosis")
    return rounded(d, 5, "jarque_bera")


# --- forecasts --------------------------------------------------------------

_WALK = f"""{CLOSES}, w AS (
  SELECT symbol, ds, close, lag(close) OVER (PARTITION BY symbol ORDER BY ds) AS prev FROM closes), f AS (
  SELECT symbol, ds, close, prev, count(*) OVER b AS history,
         regr_slope(close, prev) OVER b AS slope, regr_intercept(close, prev) OVER b AS icpt
  FROM w WINDOW b AS (PARTITION BY symbol ORDER BY ds
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), walk AS (
  SELECT symbol, ds, close, icpt + slope * prev AS y_hat FROM f WHERE history >= 10)"""


@query(f"WITH {_WALK} SELECT symbol, {_DS}, round(y_hat, 4) AS y_hat_close FROM walk")
def ar1_walk_forward_series(spark, sf_dir):
    return _shown(ar1_walk_forward(closes(spark, sf_dir)), 4, "y_hat_close")


@query(f"""WITH {_WALK} SELECT symbol, {_DS}, round(y_hat, 4) AS y_hat_close, close AS actual_close,
       round(abs(y_hat - close), 4) AS abs_error, round(abs(y_hat - close) / close, 7) AS ape FROM walk""")
def forecast_error_table(spark, sf_dir):
    c = closes(spark, sf_dir)
    errors = forecast_errors(ar1_walk_forward(c), c)
    return rounded(_shown(errors, 4, "y_hat_close", "abs_error"), 7, "ape")


_PERIOD = f"""{CLOSES}, target AS (
  SELECT CAST(unnest(generate_series(DATE '2001-07-15', DATE '2001-08-05', INTERVAL 1 DAY)) AS DATE) AS t),
history AS (
  SELECT symbol, t, ds, close, lag(close) OVER (PARTITION BY symbol, t ORDER BY ds) AS prev
  FROM closes, target WHERE ds < t)"""


_PERIOD_AR1 = f"""WITH {_PERIOD} SELECT symbol, strftime(t, '%Y-%m-%d') AS ds,
       round(regr_intercept(close, prev) + regr_slope(close, prev) * arg_max(close, ds), 4)
         AS y_hat_close FROM history GROUP BY symbol, t HAVING count(*) >= 10"""


@query(_PERIOD_AR1)
def forecast_period_native(spark, sf_dir):
    f = forecast_period(closes(spark, sf_dir), "2001-07-15", "2001-08-05")
    return _shown(f, 4, "y_hat_close")


@query(_PERIOD_AR1)
def forecast_period_recursive(spark, sf_dir):
    """The same forecasts by recursive least squares, one ordered pass per symbol."""
    fitter = RecursiveLeastSquares(order=1)
    f = forecast_period(closes(spark, sf_dir), "2001-07-15", "2001-08-05", fitter)
    return _shown(f, 4, "y_hat_close")


def _drift():
    """A fitter: the last value plus the mean step. Made here so that it is shipped by value."""
    return lambda y: float(y.iloc[-1] + (y.iloc[-1] - y.iloc[0]) / (len(y) - 1))


@query(f"""WITH {_PERIOD} SELECT symbol, strftime(t, '%Y-%m-%d') AS ds,
       round(arg_max(close, ds) + (arg_max(close, ds) - arg_min(close, ds)) / (count(*) - 1), 4)
         AS y_hat_close FROM history GROUP BY symbol, t HAVING count(*) >= 10""")
def forecast_period_fitter(spark, sf_dir):
    f = forecast_period(closes(spark, sf_dir), "2001-07-15", "2001-08-05", _drift())
    return _shown(f, 4, "y_hat_close")


@query(f"""WITH {CLOSES}, w AS (
  SELECT symbol, ds, close, lag(close) OVER (PARTITION BY symbol ORDER BY ds) AS prev FROM closes)
SELECT symbol, strftime(max(ds) + 1, '%Y-%m-%d') AS ds,
       round(regr_intercept(close, prev) + regr_slope(close, prev) * arg_max(close, ds), 4)
         AS y_hat_close FROM w GROUP BY 1 HAVING count(*) >= 10""")
def forecast_next_days(spark, sf_dir):
    return _shown(forecast_next_day(closes(spark, sf_dir)), 4, "y_hat_close")


_AR2 = f"""{RETURNS}, l AS (
  SELECT symbol, ds, ret AS y, lag(ret, 1) OVER s AS a, lag(ret, 2) OVER s AS b FROM returns
  WINDOW s AS (PARTITION BY symbol ORDER BY ds)), d AS (SELECT * FROM l WHERE b IS NOT NULL), m AS (
  SELECT symbol, count(*) AS n, avg(y) AS my, avg(a) AS ma, avg(b) AS mb, var_pop(y) * count(*) AS yy,
         var_pop(a) * count(*) AS aa, var_pop(b) * count(*) AS bb, covar_pop(a, b) * count(*) AS ab,
         covar_pop(a, y) * count(*) AS ay, covar_pop(b, y) * count(*) AS ycb,
         arg_max(y, ds) AS y1, arg_max(a, ds) AS y2, max(ds) AS last_ds FROM d GROUP BY 1), o AS (
  SELECT m.*, p,
         CASE p WHEN 0 THEN 0 WHEN 1 THEN ay / aa ELSE (ay * bb - ycb * ab) / (aa * bb - ab * ab) END AS f1,
         CASE p WHEN 2 THEN (ycb * aa - ay * ab) / (aa * bb - ab * ab) ELSE 0 END AS f2
  FROM m CROSS JOIN range(0, 3) g(p)), c AS (
  SELECT *, yy - f1 * ay - f2 * ycb AS rss, my - f1 * ma - f2 * mb AS f0 FROM o), k AS (
  SELECT *, n * (ln(2 * pi() * rss / n) + 1) + 2 * (p + 1) AS aic, rss / (n - p - 1) AS s2 FROM c), best AS (
  SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY aic, p) = 1), h AS (
  SELECT *, f0 + f1 * y1 + f2 * y2 AS h1 FROM best), h2 AS (
  SELECT *, f0 + f1 * h1 + f2 * y1 AS v2 FROM h), h3 AS (
  SELECT *, f0 + f1 * v2 + f2 * h1 AS v3, f1 AS w1, f1 * f1 + f2 AS w2 FROM h2), long AS (
  SELECT symbol, p, aic, last_ds, step,
         CASE step WHEN 1 THEN h1 WHEN 2 THEN v2 ELSE v3 END AS v,
         1.959963984540054 * sqrt(s2 * CASE step WHEN 1 THEN 1 WHEN 2 THEN 1 + w1 * w1
           ELSE 1 + w1 * w1 + w2 * w2 END) AS half FROM h3 CROSS JOIN range(1, 4) g(step))"""


@query(f"""WITH {_AR2} SELECT symbol, CAST(p AS INTEGER) AS ar_order, round(aic, 5) AS aic,
       CAST(step AS INTEGER) AS step, strftime(last_ds + CAST(step AS INTEGER), '%Y-%m-%d') AS ds,
       round(v, 7) AS forecast, round(v - half, 7) AS lower, round(v + half, 7) AS upper FROM long""")
def series_forecast_order2(spark, sf_dir):
    f = series_forecast(returns(spark, sf_dir), horizon=3, max_order=2)
    return rounded(_shown(f, 7, "forecast", "lower", "upper"), 5, "aic")


@query(f"""WITH {_AR2}, terms AS (
  SELECT symbol, p, n, s2, term, CASE term WHEN 'const' THEN f0 WHEN 'lag1' THEN f1 ELSE f2 END AS b,
         CASE WHEN p = 2 AND term = 'lag1' THEN bb / (aa * bb - ab * ab)
              WHEN p = 2 AND term = 'lag2' THEN aa / (aa * bb - ab * ab)
              WHEN p = 1 AND term = 'lag1' THEN 1 / aa
              WHEN term = 'const' AND p = 2 THEN 1.0 / n
                + (ma * ma * bb - 2 * ma * mb * ab + mb * mb * aa) / (aa * bb - ab * ab)
              WHEN term = 'const' AND p = 1 THEN 1.0 / n + ma * ma / aa ELSE 1.0 / n END AS v
  FROM best CROSS JOIN (VALUES ('const', 0), ('lag1', 1), ('lag2', 2)) x(term, lag_no) WHERE lag_no <= p), t AS (
  SELECT *, -abs(b / sqrt(s2 * v)) AS tv, (n - p - 1)::DOUBLE AS dof FROM terms)
SELECT symbol, CAST(p AS INTEGER) AS ar_order, term, round(b, 7) AS estimate,
       round(2 * {_t_cdf_sql("tv", "dof")}, 6) AS p_value FROM t""")
def series_coefficients_order2(spark, sf_dir):
    c = series_coefficients(returns(spark, sf_dir), max_order=2)
    return rounded(rounded(c, 7, "estimate"), 6, "p_value")


def _ar_sql(orders: int = 5) -> str:
    """``best(symbol, n, p, aic, s2, b0 …, e0 …, y1 …, last_ds)``: the order of least AIC, its coefficients and
    the spread e of each, from the triangular factors of the centred sums."""
    lags, y = range(1, orders + 1), orders + 1
    column = lambda i: "y" if i == y else f"l{i}"
    pairs = [(i, j) for i in range(1, y + 1) for j in range(i, y + 1)]
    lagged = ", ".join(f"lag(ret, {i}) OVER s AS l{i}" for i in lags)
    sums = ", ".join(f"covar_pop({column(i)}, {column(j)}) * count(*) AS a0_{i}_{j}" for i, j in pairs)
    means = ", ".join(f"avg({column(i)}) AS m{i}" for i in range(1, y + 1))
    newest = ", ".join(f"arg_max({column(i - 1) if i > 1 else 'y'}, ds) AS y{i}" for i in lags)
    ctes = [
        f"lagged AS (SELECT symbol, ds, ret AS y, {lagged} FROM returns WINDOW s AS (PARTITION BY symbol ORDER BY ds))",
        f"sums AS (SELECT symbol, count(*) AS n, max(ds) AS last_ds, {means}, {sums}, {newest} "
        f"FROM lagged WHERE l{orders} IS NOT NULL GROUP BY 1 HAVING count(*) >= 10)",
    ]
    before = "sums"
    for k in lags:  # what is left of the sums without the first k lags
        left = ", ".join(
            f"a{k - 1}_{i}_{j} - a{k - 1}_{k}_{i} * a{k - 1}_{k}_{j} / a{k - 1}_{k}_{k} AS a{k}_{i}_{j}" for i, j in pairs if i > k
        )
        ctes.append(f"left{k} AS (SELECT *, {left} FROM {before})")
        before = f"left{k}"
    d = lambda k: f"a{k - 1}_{k}_{k}"
    inverse = []  # of the unit triangle, column by column; later ones use earlier names
    for k in lags:
        inverse.append(f"1.0::DOUBLE AS v{k}_{k}")
        for i in range(k - 1, 0, -1):
            terms = " + ".join(f"a{i - 1}_{i}_{j} / {d(i)} * v{j}_{k}" for j in range(i + 1, k + 1))
            inverse.append(f"-({terms}) AS v{i}_{k}")
    ctes.append(f"inverse AS (SELECT *, {', '.join(inverse)} FROM {before})")
    on = lambda k, text: f"CASE WHEN p >= {k} THEN {text} ELSE 0 END"
    rss = "CASE p " + " ".join(f"WHEN {p} THEN a{p}_{y}_{y}" for p in range(orders + 1)) + " END"
    slopes = [" + ".join(on(k, f"v{i}_{k} * a{k - 1}_{k}_{y} / {d(k)}") for k in lags if k >= i) for i in lags]
    errors = [" + ".join(on(k, f"v{i}_{k} * v{i}_{k} / {d(k)}") for k in lags if k >= i) for i in lags]
    centre = " + ".join(on(k, f"pow({' + '.join(f'm{i} * v{i}_{k}' for i in range(1, k + 1))}, 2) / {d(k)}") for k in lags)
    ctes.append(
        f"orders AS (SELECT *, {rss} AS rss, {', '.join(f'{b} AS b{i}' for i, b in zip(lags, slopes))}, "
        f"{', '.join(f'{e} AS e{i}' for i, e in zip(lags, errors))}, 1.0::DOUBLE / n + {centre} AS e0 "
        f"FROM inverse CROSS JOIN range(0, {orders + 1}) g(p))"
    )
    ctes.append(
        f"best AS (SELECT *, n * (ln(2 * pi() * rss / n) + 1) + 2 * (p + 1) AS aic, rss / (n - p - 1) AS s2, "
        f"m{y} - ({' + '.join(f'b{i} * m{i}' for i in lags)}) AS b0 FROM orders WHERE n - p - 1 >= 1 "
        "QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY aic, p) = 1)"
    )
    return ", ".join(ctes)


_AR_STEPS = """steps AS (
  SELECT symbol, 1 AS step, b0 + b1 * y1 + b2 * y2 + b3 * y3 + b4 * y4 + b5 * y5 AS v, 1.0::DOUBLE AS spread,
         y1 AS r2, y2 AS r3, y3 AS r4, y4 AS r5,
         1.0::DOUBLE AS q1, 0.0::DOUBLE AS q2, 0.0::DOUBLE AS q3, 0.0::DOUBLE AS q4, 0.0::DOUBLE AS q5 FROM best
  UNION ALL
  SELECT symbol, step + 1, b0 + b1 * v + b2 * r2 + b3 * r3 + b4 * r4 + b5 * r5,
         spread + pow(b1 * q1 + b2 * q2 + b3 * q3 + b4 * q4 + b5 * q5, 2), v, r2, r3, r4,
         b1 * q1 + b2 * q2 + b3 * q3 + b4 * q4 + b5 * q5, q1, q2, q3, q4
  FROM steps JOIN best USING (symbol) WHERE step < 14)"""


@query(f"""WITH RECURSIVE {RETURNS}, {_ar_sql()}, {_AR_STEPS}
SELECT symbol, CAST(p AS INTEGER) AS ar_order, round(aic, 5) AS aic, step,
       strftime(last_ds + step, '%Y-%m-%d') AS ds, round(v, 7) AS forecast,
       round(v - 1.959963984540054 * sqrt(s2 * spread), 7) AS lower,
       round(v + 1.959963984540054 * sqrt(s2 * spread), 7) AS upper FROM steps JOIN best USING (symbol)""")
def series_forecasts(spark, sf_dir):
    f = series_forecast(returns(spark, sf_dir), horizon=14)
    return rounded(_shown(f, 7, "forecast", "lower", "upper"), 5, "aic")


@query(f"""WITH {RETURNS}, {_ar_sql()}, terms AS (
  SELECT symbol, p, n, s2, unnest([0, 1, 2, 3, 4, 5]) AS i, unnest([b0, b1, b2, b3, b4, b5]) AS b,
         unnest([e0, e1, e2, e3, e4, e5]) AS e FROM best), t AS (
  SELECT *, -abs(b / sqrt(s2 * e)) AS tv, (n - p - 1)::DOUBLE AS dof FROM terms WHERE i <= p)
SELECT symbol, CAST(p AS INTEGER) AS ar_order, CASE WHEN i = 0 THEN 'const' ELSE 'lag' || i END AS term,
       round(b, 7) AS estimate, round(2 * {_t_cdf_sql("tv", "dof")}, 6) AS p_value FROM t""")
def series_coefficient_table(spark, sf_dir):
    c = series_coefficients(returns(spark, sf_dir))
    return rounded(rounded(c, 7, "estimate"), 6, "p_value")


# --- risk -------------------------------------------------------------------


@query(f"""WITH {RETURNS}, runs AS (
  SELECT symbol, count(*) OVER w AS c, sum(ret) OVER w AS s FROM returns
  WINDOW w AS (PARTITION BY symbol ORDER BY ds ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)), r AS (
  SELECT symbol, exp(s) - 1 AS ret FROM runs WHERE c = 30)
SELECT symbol, count(*) AS n,
       round(avg(CASE WHEN ret < -0.3 THEN 1.0::DOUBLE ELSE 0.0 END), 9) AS prob_drawdown,
       round(quantile_cont(ret, 0.05::DOUBLE), 8) AS value_at_risk FROM r GROUP BY 1""")
def tail_risk_30d(spark, sf_dir):
    risk = tail_risk(returns(spark, sf_dir))
    return rounded(rounded(risk, 9, "prob_drawdown"), 8, "value_at_risk")


_SCENARIO_DAYS, _SCENARIO_PATHS = 30, 10_000

_SCENARIOS = f"""{_T_FIT}, draws AS (
  SELECT symbol, path, md5('42|' || symbol || '|' || path || '|' || day) AS h
  FROM tfit CROSS JOIN range(1, {_SCENARIO_PATHS} + 1) p(path)
  CROSS JOIN range(1, {_SCENARIO_DAYS} + 1) d(day)), uniforms AS (
  SELECT symbol, path, (CAST('0x' || substr(h, 1, 13) AS BIGINT)::DOUBLE + 0.5) / pow(2, 52) AS u,
         (CAST('0x' || substr(h, 14, 13) AS BIGINT)::DOUBLE + 0.5) / pow(2, 52) AS v FROM draws), paths AS (
  SELECT symbol, path, sum(sqrt(df * (pow(u, -2 / df) - 1)) * cos(2 * pi() * v)) AS t,
         any_value(loc) AS loc, any_value(scale) AS scale
  FROM uniforms JOIN tfit USING (symbol) GROUP BY 1, 2), finals AS (
  SELECT symbol, scenario, exp({_SCENARIO_DAYS} * loc + scale * factor * t) - 1 AS ret
  FROM paths CROSS JOIN (VALUES ('baseline', 1.0::DOUBLE), ('reduced', 0.8::DOUBLE)) s(scenario, factor))"""


@query(f"""WITH RECURSIVE {_SCENARIOS} SELECT symbol, scenario, count(*) AS n,
       round(avg(CASE WHEN ret < -0.3 THEN 1.0::DOUBLE ELSE 0.0 END), 9) AS prob_drawdown,
       round(quantile_cont(ret, 0.05::DOUBLE), 5) AS value_at_risk FROM finals GROUP BY 1, 2""")
def scenario_risk_table(spark, sf_dir):
    params = fit_student_t(returns(spark, sf_dir))
    risk = scenario_risk(params, days=_SCENARIO_DAYS, paths=_SCENARIO_PATHS)
    return rounded(rounded(risk, 9, "prob_drawdown"), 5, "value_at_risk")


@query(f"""WITH RECURSIVE {_SCENARIOS}, returns2 AS (
  SELECT symbol || '/' || scenario AS symbol, ret FROM finals), q AS (
  SELECT symbol, quantile_cont(ret, 0.005::DOUBLE) AS lo, quantile_cont(ret, 0.995::DOUBLE) AS hi
  FROM returns2 GROUP BY 1), clipped AS (
  SELECT r.* FROM returns2 r JOIN q USING (symbol) WHERE ret BETWEEN lo AND hi),
{_histogram_sql("clipped", 80)}
SELECT symbol, bin, n, round(ln(1 + upper), 5) AS log_upper, observed FROM hist""")
def scenario_histogram(spark, sf_dir):
    paths = scenario_paths(fit_student_t(returns(spark, sf_dir)))
    labelled = paths.select(F.concat_ws("/", "symbol", "scenario").alias("symbol"), "ret")
    # Simulated returns span many orders of magnitude, so edges are compared on a log scale.
    bins = histogram(clip_central(labelled)).withColumn("log_upper", F.log1p("upper"))
    return rounded(bins.drop("density", "lower", "upper"), 5, "log_upper")
