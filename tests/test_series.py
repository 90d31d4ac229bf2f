import datetime as dt
import glob
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barflow.functions import numerics as N
from barflow.operators.bars import (
    daily_close,
    daily_close_from_text,
    dedup_dates,
    forecast_calendar,
    latest_value,
    next_day,
    tail_n,
)
from barflow.operators.describe import (
    clip_central,
    density_grid,
    describe_returns,
    fit_normal,
    histogram,
    tail_prob_empirical,
)
from barflow.operators.fits import (
    chi_square_normal,
    fit_params,
    fit_student_t,
    ks_test,
    qq_normal,
    qq_student_t,
    tail_prob_normal,
    tail_prob_t,
)
from barflow.operators.regression import ar1_fit, ar1_fitted, ar1_forecast, residual_diagnostics
from barflow.operators.returns import (
    cumulative_path,
    empirical_rank,
    lag_design,
    log_returns,
    rolling_return,
    simple_returns,
)
from barflow.operators.risk import scenario_paths, scenario_risk, tail_risk
from conftest import rows_by

DAY = dt.date(2024, 1, 1)


def closes(spark, values, symbol="A"):
    rows = [(symbol, DAY + dt.timedelta(days=i), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "symbol string, ds date, close double")


def test_returns_guard_against_bad_prices(spark):
    df = closes(spark, [1.0, 2.0, 0.0, 3.0, -1.0, -2.0, None, 4.0])
    logs = [round(r.ret, 9) for r in log_returns(df).orderBy("ds").collect()]
    assert logs == [round(math.log(2), 9), round(math.log(2), 9)]
    simple = [r.ret for r in simple_returns(df).orderBy("ds").collect()]
    assert simple[:2] == [1.0, -1.0] and len(simple) == 4
    assert log_returns(closes(spark, [5.0])).count() == 0


def test_series_need_dates(spark):
    with pytest.raises(ValueError):
        log_returns(spark.createDataFrame([("A", 1, 1.0)], "symbol string, ds bigint, close double"))


def test_lags_paths_ranks_and_runs(spark):
    df = spark.createDataFrame([("A", DAY + dt.timedelta(days=2 * i), float(i)) for i in range(5)], "symbol string, ds date, ret double")
    assert [(r.ret, r.lag1, r.lag2) for r in lag_design(df, "ret", 2).orderBy("ds").collect()] == [(2.0, 1.0, 0.0), (3.0, 2.0, 1.0), (4.0, 3.0, 2.0)]
    assert [round(r.price / 2, 6) for r in cumulative_path(df, "ret", 2.0).orderBy("ds").collect()] == [round(math.exp(s), 6) for s in (0, 1, 3, 6, 10)]
    assert [r.position for r in empirical_rank(df).orderBy("i").collect()] == [0.1, 0.3, 0.5, 0.7, 0.9]
    assert [round(r.ret, 6) for r in rolling_return(df, 3).orderBy("ds").collect()] == [round(math.exp(s) - 1, 6) for s in (3, 6, 9)]


def test_daily_closes(spark):
    rows = [("2025-01-01T00:00:00+00:00", "A", 1.0), ("2025-01-01T23:00:00Z", "A", 2.0), ("2025-01-01T23:30:00Z", "A", None),
            ("bad", "A", 9.0), ("2025-01-02T00:00:00Z", None, 9.0)]
    df = spark.createDataFrame(rows, "iso_ts string, symbol string, close double")
    assert [(str(r.ds), r.close) for r in daily_close_from_text(df).collect()] == [("2025-01-01", 2.0)]
    ticks = spark.createDataFrame([("A", 0, 1.0), ("A", 5, 2.0), ("A", 86_400_000, 3.0)], "symbol string, ts bigint, close double")
    daily = daily_close(ticks)
    assert sorted(r.close for r in daily.collect()) == [2.0, 3.0]
    assert str(next_day(daily).head().ds) == "1970-01-03"
    assert [str(r.ds) for r in forecast_calendar(daily, 2).orderBy("step").collect()] == ["1970-01-03", "1970-01-04"]
    assert latest_value(daily, "close").head().close == 3.0
    dated = ticks.withColumn("ds", F.lit(DAY))
    assert dedup_dates(dated, "close", "first", ("ts",)).head().close == 1.0
    with pytest.raises(ValueError):
        dedup_dates(dated, "close", "middle", ("ts",))


def test_tail_keeps_the_last_rows(spark, series):
    df, values = series
    got = tail_n(df, 3).where("symbol = 'A'").orderBy("ds").collect()
    assert np.allclose([r.ret for r in got], values["A"][-3:])


def test_moments_match_pandas(spark, series):
    df, values = series
    got = rows_by(describe_returns(df), "symbol")
    for symbol, array in values.items():
        s, r = pd.Series(array), got[symbol]
        assert np.allclose([r.mean, r.variance, r.std, r.skewness, r.kurtosis], [s.mean(), s.var(), s.std(), s.skew(), s.kurt()])
        assert np.isclose(r.ci_upper - r.ci_lower, 2 * 1.96 * s.std() / math.sqrt(len(s)))
        assert np.isclose(rows_by(tail_prob_empirical(df, 0.04), "symbol")[symbol].tail_empirical, (abs(s) > 0.04).mean())


def test_moment_guards(spark):
    df = spark.createDataFrame([("one", 1.0), ("two", 1.0), ("two", 2.0), ("flat", 3.0), ("flat", 3.0), ("flat", 3.0), ("none", None)], "symbol string, ret double")
    got = rows_by(describe_returns(df), "symbol")
    assert set(got) == {"two", "flat"} and got["two"].skewness is None and got["two"].kurtosis is None
    assert {r.symbol for r in fit_normal(df).collect()} == {"two"}


@pytest.mark.parametrize("bins", [1, 7, 80])
def test_histogram_matches_numpy(spark, series, bins):
    df, values = series
    got = histogram(df, bins).orderBy("symbol", "bin").collect()
    for symbol, array in values.items():
        counts, edges = np.histogram(array, bins)
        mine = [r for r in got if r.symbol == symbol]
        assert [r.observed for r in mine] == counts.tolist()
        assert np.allclose([r.lower for r in mine], edges[:-1]) and np.allclose([r.upper for r in mine], edges[1:])
        assert np.isclose(sum(r.density * (r.upper - r.lower) for r in mine), 1)


def test_histogram_of_a_constant(spark):
    df = spark.createDataFrame([("A", 2.0)] * 4, "symbol string, ret double")
    got = histogram(df, 4).orderBy("bin").collect()
    assert [r.observed for r in got] == np.histogram([2.0] * 4, 4)[0].tolist() and got[0].lower == 1.5


def test_clip_keeps_the_centre(spark, series):
    df, values = series
    low, high = np.quantile(values["A"], [0.05, 0.95])
    kept = clip_central(df, 0.9).where("symbol = 'A'").count()
    assert kept == ((values["A"] >= low) & (values["A"] <= high)).sum()


def _log_likelihood(x, v, loc, scale):
    z = (x - loc) / scale
    constant = math.lgamma((v + 1) / 2) - math.lgamma(v / 2) - 0.5 * math.log(v * math.pi) - math.log(scale)
    return len(x) * constant - (v + 1) / 2 * np.log1p(z * z / v).sum()


@pytest.fixture(scope="module")
def params(series):
    return fit_params(series[0])


def test_student_t_fit_is_a_maximum(spark, series, params):
    fit, x = rows_by(params, "symbol")["A"], series[1]["A"]
    best = _log_likelihood(x, fit.df, fit.loc, fit.scale)
    for dv, dl, ds in [(1.01, 0, 1), (0.99, 0, 1), (1, 1e-4, 1), (1, -1e-4, 1), (1, 0, 1.005), (1, 0, 0.995), (1.02, 1e-4, 1.005)]:
        assert _log_likelihood(x, fit.df * dv, fit.loc + dl, fit.scale * ds) < best
    assert 2 < fit.df < 9


def test_student_t_fit_guards(spark):
    rows = [("two", 1.0), ("two", 2.0), *[("flat", 1.0)] * 5, *[("even", float(i)) for i in range(60)]]
    got = rows_by(fit_student_t(spark.createDataFrame(rows, "symbol string, ret double")), "symbol")
    assert set(got) == {"even"} and got["even"].df > 500  # light tails end at the normal limit


def test_student_t_search_is_reported(spark):
    import random

    from barflow.operators.fits import student_t_report
    from barflow.session import shared_dir

    rng = random.Random(3)
    rows = [("two", 1.0), ("two", 2.0), *[("flat", 1.0)] * 5, *[("zeros", 0.0)] * 90]
    rows += [("zeros", rng.gauss(0, 1)) for _ in range(10)] + [("t", rng.gauss(0, 1) / rng.random()) for _ in range(200)]
    df = spark.createDataFrame(rows, "symbol string, ret double")
    before = set(glob.glob(f"{shared_dir(spark).removeprefix('file:')}/*"))
    got = rows_by(student_t_report(df), "symbol")
    left = set(glob.glob(f"{shared_dir(spark).removeprefix('file:')}/*")) - before
    assert len(left) == 1 and "t-fits" in left.pop()
    assert {s: r.status for s, r in got.items()} == {"two": "too_few", "flat": "no_spread", "zeros": "degenerate", "t": "converged"}
    assert got["t"].steps < 60 and not got["t"].at_bound and got["zeros"].df is None
    short = rows_by(student_t_report(df, max_steps=2), "symbol")
    assert short["t"].status == "max_steps" and "t" not in rows_by(fit_student_t(df, max_steps=2), "symbol")


def test_tails_and_density(spark, series, params):
    both = rows_by(tail_prob_t(tail_prob_normal(params, 0.05), 0.05), "symbol")["A"]
    n = math.erfc((0.05 - both.mu) / both.sigma / math.sqrt(2)) / 2 + math.erfc((0.05 + both.mu) / both.sigma / math.sqrt(2)) / 2
    assert np.isclose(both.tail_normal, n)
    x = np.linspace(-20, 20, 4_000_001)
    density = np.exp(both.t_log_norm - (both.df + 1) / 2 * np.log1p(((x - both.loc) / both.scale) ** 2 / both.df))
    inside = np.abs(x) <= 0.05
    assert np.isclose(1 - np.trapezoid(density[inside], x[inside]), both.tail_t, atol=1e-4)
    grid = density_grid(series[0], params, 50).where("symbol = 'A'").orderBy("point").collect()
    assert len(grid) == 50 and np.isclose(grid[0].x, series[1]["A"].min()) and np.isclose(grid[-1].x, series[1]["A"].max())
    assert np.isclose(grid[20].normal_density, math.exp(-(((grid[20].x - both.mu) / both.sigma) ** 2) / 2) / both.sigma / math.sqrt(2 * math.pi))


def test_ks_distances(spark, series, params):
    got = {(r.symbol, r.distribution): r for r in ks_test(series[0], params).collect()}
    fit = rows_by(params, "symbol")["B"]
    x = np.sort(series[1]["B"])
    n = len(x)
    cdf = np.array([0.5 * math.erfc(-(v - fit.mu) / fit.sigma / math.sqrt(2)) for v in x])
    d = max((np.arange(1, n + 1) / n - cdf).max(), (cdf - np.arange(n) / n).max())
    assert np.isclose(got["B", "normal"].d, d, atol=1e-9)
    assert 0 < got["B", "student_t"].d < 0.1 and got["B", "normal"].p_value > 0.05
    few = series[0].where("symbol = 'A'").limit(9)
    assert ks_test(few, params).count() == 0


def test_chi_square(spark, series):
    got = rows_by(chi_square_normal(series[0], 20), "symbol")
    for symbol, array in series[1].items():
        counts, edges = np.histogram(array, 20)
        mu, sigma = array.mean(), array.std(ddof=1)
        cdf = np.array([0.5 * math.erfc(-(e - mu) / sigma / math.sqrt(2)) for e in edges])
        expected = np.diff(cdf) * len(array)
        used = expected >= 5
        chi2 = ((counts[used] - expected[used]) ** 2 / expected[used]).sum()
        assert np.isclose(got[symbol].chi2, chi2) and got[symbol].dof == used.sum() - 3
        assert np.isclose(got[symbol].p_value, N.gamma_q((used.sum() - 3) / 2, chi2 / 2))
    assert chi_square_normal(series[0], 201).count() == 0


def test_qq_points(spark, series, params):
    points = qq_normal(series[0], params).where("symbol = 'A'").orderBy("i").collect()
    assert [p.empirical for p in points] == sorted(p.empirical for p in points)
    n = len(points)
    assert np.isclose(points[-1].position, 0.5 ** (1 / n)) and np.isclose(points[0].position, 1 - 0.5 ** (1 / n))
    assert np.isclose(points[9].position, (10 - 0.3175) / (n + 0.365))
    fit = rows_by(params, "symbol")["A"]
    t = qq_student_t(series[0], params).where("symbol = 'A'").orderBy("i").collect()
    z = np.array([(p.theoretical - fit.loc) / fit.scale for p in t])
    assert np.allclose(N.student_t_cdf_array(z, fit.df), [p.position for p in t], atol=1e-10)


def test_ar1_matches_least_squares(spark, series):
    df, values = series
    fit = rows_by(ar1_fit(df), "symbol")["A"]
    y, x = values["A"][1:], values["A"][:-1]
    design = np.column_stack([np.ones_like(x), x])
    beta, rss, *_ = np.linalg.lstsq(design, y, rcond=None)
    cov = np.linalg.inv(design.T @ design) * rss[0] / (len(y) - 2)
    assert np.allclose([fit.const, fit.lag1], beta) and np.isclose(fit.r2, 1 - rss[0] / ((y - y.mean()) ** 2).sum())
    t = np.abs(beta) / np.sqrt(np.diag(cov))
    assert np.allclose([fit.p_const, fit.p_lag1], 2 * N.student_t_sf_array(t, len(y) - 2))
    e = y - design @ beta
    fitted = ar1_fitted(df, ar1_fit(df))
    assert np.allclose([r.residual for r in fitted.where("symbol = 'A'").orderBy("ds").collect()], e)
    assert np.isclose(rows_by(ar1_forecast(df, ar1_fit(df)), "symbol")["A"].forecast, beta[0] + beta[1] * values["A"][-1])
    d = rows_by(residual_diagnostics(fitted), "symbol")["A"]
    n = len(e)
    assert np.isclose(d.durbin_watson, (np.diff(e) ** 2).sum() / (e @ e))
    assert np.isclose(d.aic, n * (math.log(2 * math.pi) + math.log(e @ e / n) + 1) + 4)
    c = e - e.mean()
    rho = (c[1:] @ c[:-1]) / (c @ c)
    assert np.isclose(d.ljung_box, n * (n + 2) * rho**2 / (n - 1), atol=1e-9)
    assert np.isclose(d.ljung_box_p, math.erfc(math.sqrt(d.ljung_box / 2)))
    s, k = (c**3).mean() / (c**2).mean() ** 1.5, (c**4).mean() / (c**2).mean() ** 2 - 3
    assert np.isclose(d.jarque_bera, n / 6 * (s * s + k * k / 4))


def test_ar1_guards(spark):
    short = spark.createDataFrame([("A", DAY, 1.0), ("A", DAY + dt.timedelta(1), 2.0), *[("C", DAY + dt.timedelta(i), 1.0) for i in range(9)]], "symbol string, ds date, ret double")
    assert ar1_fit(short).count() == 0


def test_tail_risk_matches_numpy(spark, series):
    df, values = series
    got = rows_by(tail_risk(df, 5), "symbol")["A"]
    total = np.convolve(values["A"], np.ones(5), "valid")
    runs = np.exp(total) - 1
    assert got.n == len(runs) and np.isclose(got.value_at_risk, np.quantile(runs, 0.05))
    assert np.isclose(got.prob_drawdown, (runs < -0.3).mean())


def test_scenario_draws_follow_the_fit_and_repeat(spark):
    fit = spark.createDataFrame([("A", 3.0, 0.001, 0.02)], "symbol string, df double, loc double, scale double")
    paths = scenario_paths(fit, days=1, paths=4000)
    base = np.sort([math.log1p(r.ret) for r in paths.where("scenario = 'baseline'").collect()])
    u = N.student_t_cdf_array((base - 0.001) / 0.02, 3.0)
    n = len(u)
    d = max((np.arange(1, n + 1) / n - u).max(), (u - np.arange(n) / n).max())
    assert N.kolmogorov_sf_exact(d, n) > 0.01
    key = lambda r: (r.scenario, r.path)
    first = sorted(paths.collect(), key=key)
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    second = sorted(scenario_paths(fit, days=1, paths=4000).collect(), key=key)
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert [key(r) for r in first] == [key(r) for r in second]
    assert np.allclose([r.ret for r in first], [r.ret for r in second])
    risk = rows_by(scenario_risk(fit, days=30, paths=2000), "scenario")
    assert risk["reduced"].value_at_risk > risk["baseline"].value_at_risk and risk["baseline"].n == 2000


def test_numeric_helpers(spark):
    z = [-8.0, -3.0, -0.5, 0.0, 0.5, 3.0, 7.5, 12.0, 40.0]
    got = spark.createDataFrame([(v,) for v in z], "z double").select(N.normal_sf(F.col("z"))).collect()
    assert np.allclose([r[0] for r in got], [0.5 * math.erfc(v / math.sqrt(2)) for v in z], rtol=1e-7, atol=1e-15)
    p = np.array([1e-9, 0.01, 0.3, 0.5, 0.9, 1 - 1e-6])
    for v in (0.5, 1.0, 2.35, 30.0):
        assert np.allclose(N.student_t_cdf_array(N.student_t_ppf_array(p, v), v), p, rtol=1e-8)
    assert np.isclose(N.kolmogorov_sf_exact(0.274, 10), 1 - 0.6284796154, atol=1e-9)
    assert np.isclose(N.beta_inc(2.0, 3.0, 0.4), 0.5248)
    expressions = [N.digamma_sql("x"), N.trigamma_sql("x")]
    r = spark.range(1).selectExpr("1D AS x").selectExpr(*expressions).head()
    assert np.allclose(list(r), [-0.5772156649015329, math.pi**2 / 6])


def test_kolmogorov_on_both_sides_of_the_switch():
    for n in (10, 60, 500, 3000):
        for s in (4.5, 5.5, 5.99, 6.01, 7.0):
            d = (s / n) ** 0.5
            if d >= 1:
                continue
            band, sides = 1 - N._band_probability(d, n), 2 * N._one_sided(d, n)
            assert abs(band - sides) < 1e-12 + sides * np.exp(-6 * s) and N.kolmogorov_sf_exact(d, n) in (band, sides)
    # exact values for two and three observations: the band's volume
    for d in (0.3, 0.5, 0.62, 0.9):
        inside = max(0.0, 2 * d - 0.5) ** 2 * 2 if d < 0.5 else 1 - 2 * (1 - d) ** 2
        assert np.isclose(N.kolmogorov_sf_exact(d, 2), 1 - inside, atol=1e-12)
    assert N.kolmogorov_sf_exact(0.5, 400) < 1e-40 and N.kolmogorov_sf_exact(1e-9, 50) == 1.0
    assert N.kolmogorov_sf_exact(0.0, 5) == 1.0 and N.kolmogorov_sf_exact(1.0, 5) == 0.0


def _bisected(p, v):
    low, high = 0.0, 40.0
    for _ in range(70):
        mid = (low + high) / 2
        low, high = (mid, high) if N.student_t_sf_array(np.sinh(mid), v) > min(p, 1 - p) else (low, mid)
    return float(np.sign(p - 0.5) * np.sinh((low + high) / 2))


def test_student_t_quantiles_equal_bisection(monkeypatch):
    p = np.array([1e-12, 1e-6, 1e-3, 0.01, 0.1, 0.3, 0.49, 0.4999999, 0.5, 0.50001, 0.6, 0.95, 0.999, 1 - 1e-9])
    for v in (0.1, 0.5, 1.0, 2.0, 2.35, 4.0, 30.0, 1000.0):
        calls = []
        real = N.student_t_sf_array
        monkeypatch.setattr(N, "student_t_sf_array", lambda x, nu: calls.append(np.size(x)) or real(x, nu))
        got = N.student_t_ppf_array(p, np.full(len(p), v))
        monkeypatch.undo()
        want = np.array([_bisected(q, v) for q in p])
        # near the median the tail itself is only known to rounding
        assert np.allclose(got, want, rtol=1e-10, atol=1e-12), v
        assert sum(calls) < 16 * len(p)  # evaluations; bisection takes 60 each
    edge = N.student_t_ppf_array(np.array([0.0, 1.0, -0.1, 1.1, np.nan]), np.full(5, 3.0))
    assert edge[0] == -np.inf and edge[1] == np.inf and np.isnan(edge[2:]).all()
    assert N.student_t_ppf_array(np.array([]), np.array([])).shape == (0,) and N.student_t_ppf_array(0.975, 5.0).shape == ()
