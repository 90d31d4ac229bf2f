import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from barflow.functions.recursive import RecursiveLeastSquares
from barflow.operators.forecast import (
    ar1_walk_forward,
    forecast_errors,
    forecast_next_day,
    forecast_period,
    series_coefficients,
    series_forecast,
    walk_rows,
)

DAY = dt.date(2024, 1, 1)


@pytest.fixture(scope="module")
def walk(spark):
    rng = np.random.default_rng(8)
    values = 100 + np.cumsum(rng.normal(0, 1, 40))
    days = [DAY + dt.timedelta(days=i) for i in range(40) if i % 6 != 5]
    rows = [("A", d, float(v)) for d, v in zip(days, values)]
    return spark.createDataFrame(rows + [("S", d, v) for _, d, v in rows[:9]], "symbol string, ds date, close double"), rows


def _ar1(history):
    y = np.array(history)
    slope, intercept = np.polyfit(y[:-1], y[1:], 1)
    return intercept + slope * y[-1]


def test_walk_forward_matches_refits(walk):
    df, rows = walk
    got = {r.ds: r.y_hat_close for r in ar1_walk_forward(df).collect()}
    want = {d: _ar1([v for _, _, v in rows[:i]]) for i, (_, d, _) in enumerate(rows) if i >= 10}
    assert got.keys() == want.keys()
    assert np.allclose([got[d] for d in want], list(want.values()))


def test_period_covers_days_without_an_actual(walk):
    df, rows = walk
    first, last = DAY + dt.timedelta(days=20), DAY + dt.timedelta(days=60)
    native = {r.ds: r.y_hat_close for r in forecast_period(df, first, last).where("symbol = 'A'").collect()}
    want = {}
    for i in range(41):
        day = first + dt.timedelta(days=i)
        history = [v for _, d, v in rows if d < day]
        want[day] = _ar1(history)
    assert native.keys() == want.keys() and np.allclose([native[d] for d in want], list(want.values()))

    def fitter(y):
        import numpy

        slope, intercept = numpy.polyfit(y[:-1], y[1:], 1)
        return intercept + slope * y.iloc[-1]

    fitted = {r.ds: r.y_hat_close for r in forecast_period(df, first, last, fitter, targets_per_task=7).where("symbol = 'A'").collect()}
    assert fitted.keys() == want.keys() and np.allclose([fitted[d] for d in want], list(want.values()))
    with pytest.raises(ValueError):
        forecast_period(df, last, first)


def test_next_day_needs_ten_values(walk):
    df, rows = walk
    for forecast in (forecast_next_day(df), forecast_next_day(df, lambda y: float(y.mean()))):
        got = forecast.collect()
        assert [r.symbol for r in got] == ["A"] and got[0].ds == rows[-1][1] + dt.timedelta(days=1)
    assert np.isclose(forecast_next_day(df).head().y_hat_close, _ar1([v for *_, v in rows]))
    assert forecast_next_day(df, lambda y: None).count() == 0


def test_errors_without_and_with_zero_actual(spark):
    f = spark.createDataFrame([("A", DAY, 2.0), ("B", DAY, 2.0), ("C", DAY, 2.0)], "symbol string, ds date, y_hat_close double")
    a = spark.createDataFrame([("A", DAY, 4.0), ("B", DAY, 0.0)], "symbol string, ds date, close double")
    got = {r.symbol: (r.actual_close, r.abs_error, r.ape) for r in forecast_errors(f, a).collect()}
    assert got == {"A": (4.0, 2.0, 0.5), "B": (0.0, 2.0, None), "C": (None, None, None)}


def test_autoregression_picks_order_and_matches_lstsq(spark):
    rng = np.random.default_rng(4)
    y = [0.0, 0.0]
    for e in rng.normal(0, 1, 800):
        y.append(0.3 + 0.5 * y[-1] - 0.4 * y[-2] + e)
    y = np.array(y[2:])
    df = spark.createDataFrame([("A", DAY + dt.timedelta(days=i), float(v)) for i, v in enumerate(y)], "symbol string, ds date, ret double")
    steps = series_forecast(df, 3, 4).orderBy("step").collect()
    order = steps[0].ar_order
    assert order >= 2
    target = y[4:]
    design = np.column_stack([np.ones(len(target)), *[y[4 - i:-i] for i in range(1, order + 1)]])
    beta, rss, *_ = np.linalg.lstsq(design, target, rcond=None)
    history = list(y)
    for s in steps:
        mean = beta[0] + sum(b * history[-i] for i, b in enumerate(beta[1:], start=1))
        assert np.isclose(s.forecast, mean) and s.lower < mean < s.upper
        history.append(mean)
    assert np.isclose(steps[0].upper - steps[0].forecast, 1.959963984540054 * np.sqrt(rss[0] / (len(target) - order - 1)))
    assert [str(s.ds) for s in steps] == [str(DAY + dt.timedelta(days=800 + i)) for i in range(3)]
    terms = {r.term: r for r in series_coefficients(df, 4).collect()}
    assert np.allclose([terms[t].estimate for t in ("const", "lag1", "lag2")], beta[:3]) and terms["lag1"].p_value < 1e-6
    with pytest.raises(ValueError):
        series_forecast(df, 0)


def test_series_forecast_takes_a_fitter(spark, series):
    df, values = series

    def fitter(y, horizon):
        mean, half = y.mean(), 2 * y.std()
        return [(mean, mean - half, mean + half)] * horizon

    got = series_forecast(df, 4, fitter=fitter).where("symbol = 'B'").orderBy("step").collect()
    assert [r.step for r in got] == [1, 2, 3, 4] and got[0].ar_order is None
    assert np.isclose(got[3].forecast, values["B"].mean()) and got[3].lower < got[3].upper
    assert str(got[0].ds) == str(dt.date(2020, 1, 1) + dt.timedelta(days=300))
    assert series_forecast(df, 4).columns == ["symbol", "step", "ds", "ar_order", "aic", "forecast", "lower", "upper"]
    few = df.where("ds < '2020-01-09'")
    assert series_forecast(few, 2, fitter=fitter).count() == 0


def test_results_do_not_depend_on_partitioning(spark, walk):
    df, _ = walk
    first = sorted(ar1_walk_forward(df).collect())
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    second = sorted(ar1_walk_forward(df.repartition(11)).collect())
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert [(r.symbol, r.ds) for r in first] == [(r.symbol, r.ds) for r in second]
    assert np.allclose([r.y_hat_close for r in first], [r.y_hat_close for r in second])


def _least_squares(y, order, weights=None):
    import numpy

    y = numpy.asarray(y)
    design = numpy.column_stack([numpy.ones(len(y) - order), *[y[order - i : len(y) - i] for i in range(1, order + 1)]])
    w = numpy.sqrt(numpy.ones(len(design)) if weights is None else weights)
    beta = numpy.linalg.lstsq(design * w[:, None], y[order:] * w, rcond=None)[0]
    return beta[0] + beta[1:] @ y[-1 : -order - 1 : -1]


@pytest.mark.parametrize(("order", "offset"), [(1, 0.0), (2, 1e6), (5, 0.0), (3, 1e5)])
def test_recursive_least_squares_equals_a_refit(order, offset):
    rng = np.random.default_rng(order)
    y = offset + np.cumsum(rng.normal(0, 1, 80))
    fitter, state = RecursiveLeastSquares(order), RecursiveLeastSquares(order).start()
    for i, value in enumerate(y):
        state = fitter.update(state, value)
        if i < 2 * order:
            assert fitter.forecast(state) is None
        elif i > 3 * order + 2:
            assert np.isclose(fitter.forecast(state), _least_squares(y[: i + 1], order), rtol=1e-9, atol=1e-6)


def test_forgetting_and_series_that_do_not_vary():
    rng = np.random.default_rng(9)
    y = rng.normal(0, 1, 60)
    fitter = RecursiveLeastSquares(2, forgetting=0.9)
    state = fitter.start()
    for value in y:
        state = fitter.update(state, value)
    assert np.isclose(fitter.forecast(state), _least_squares(y, 2, 0.9 ** np.arange(57, -1, -1)))
    flat = RecursiveLeastSquares(1)
    state = flat.start()
    for _ in range(30):
        state = flat.update(state, 5.0)
    assert flat.forecast(state) is None


def test_one_ordered_pass_takes_each_row_once(spark, walk):
    df, rows = walk
    first, last = DAY + dt.timedelta(days=20), DAY + dt.timedelta(days=60)
    native = {(r.symbol, r.ds): r.y_hat_close for r in forecast_period(df, first, last).collect()}
    got = {(r.symbol, r.ds): r.y_hat_close for r in forecast_period(df, first, last, RecursiveLeastSquares()).collect()}
    assert got.keys() == native.keys() and np.allclose([got[k] for k in native], list(native.values()))
    reached = walk_rows(df, first, last, "close")
    before = df.where((F.col("ds") < F.lit(last)) & F.col("close").isNotNull())
    assert reached.count() == before.count() + 41 * before.select("symbol").distinct().count()
    mean = {(r.symbol, r.ds): r.y_hat_close for r in forecast_period(df, first, last, lambda y: float(y.mean())).collect()}
    history = [v for _, d, v in rows if d < last]
    assert np.isclose(mean["A", last], np.mean(history))
    assert forecast_period(df, first, last, lambda y: None).count() == 0
    assert forecast_period(df.limit(0), first, last, RecursiveLeastSquares()).count() == 0
    with pytest.raises(ValueError):
        forecast_period(df, first, last, RecursiveLeastSquares(), targets_per_task=4)


def test_an_incremental_fitter_of_ones_own(spark, walk):
    class Count:
        def start(self):
            return 0

        def update(self, state, value):
            return state + 1

        def forecast(self, state):
            return float(state)

    df, rows = walk
    day = DAY + dt.timedelta(days=30)
    got = {r.symbol: r.y_hat_close for r in forecast_period(df, day, day, Count(), min_history=1).collect()}
    assert got["A"] == sum(d < day for _, d, _ in rows)


def _plain_orders(y, max_order):
    """Order, coefficients, AIC and standard errors by least squares of every order."""
    target, n, best = y[max_order:], len(y) - max_order, None
    for p in range(max_order + 1):
        design = np.column_stack([np.ones(n), *[y[max_order - i : len(y) - i] for i in range(1, p + 1)]])
        q, r = np.linalg.qr(design)
        beta = np.linalg.solve(r, q.T @ target)
        rss = ((target - design @ beta) ** 2).sum()
        aic = n * (np.log(2 * np.pi * rss / n) + 1) + 2 * (p + 1)
        errors = np.sqrt(rss / (n - p - 1) * (np.linalg.inv(r) ** 2).sum(axis=1))
        if best is None or aic < best[2]:
            best = (p, beta, aic, errors)
    return best


@pytest.mark.parametrize("offset", [0.0, 60_000.0, 1e9])
def test_orders_far_from_zero_equal_least_squares(spark, offset):
    rng = np.random.default_rng(5)
    rows, plain = [], {}
    for symbol, slopes in (("A", [0.4, 0.0, 0.3]), ("B", []), ("C", [0.2, -0.3, 0.1, 0.0, 0.4])):
        y = list(rng.normal(0, 1, 6))
        for _ in range(400):
            y.append(sum(b * v for b, v in zip(slopes, reversed(y))) + rng.normal())
        y = np.array(y) + offset
        plain[symbol] = _plain_orders(y, 5)
        rows += [(symbol, DAY + dt.timedelta(days=i), float(v)) for i, v in enumerate(y)]
    df = spark.createDataFrame(rows, "symbol string, ds date, ret double")
    first = {r.symbol: r for r in series_forecast(df, 1).collect()}
    terms = {(r.symbol, r.term): r for r in series_coefficients(df).collect()}
    for symbol, (p, beta, aic, errors) in plain.items():
        assert first[symbol].ar_order == p and np.isclose(first[symbol].aic, aic, rtol=1e-7)
        names = ["const", *[f"lag{i}" for i in range(1, p + 1)]]
        got = [terms[symbol, name].estimate for name in names]
        assert np.allclose(got[1:], beta[1:], atol=1e-6) and np.isclose(got[0], beta[0], rtol=1e-5, atol=1e-5 + 1e-6 * offset)
        assert len([k for k in terms if k[0] == symbol]) == p + 1
        if p:
            z = abs(beta[1] / errors[1])
            assert (terms[symbol, "lag1"].p_value < 0.05) == (z > 1.966) or abs(z - 1.966) < 0.01


def test_series_without_usable_lags(spark):
    days = [DAY + dt.timedelta(days=i) for i in range(40)]
    rows = [("flat", d, 3.0) for d in days] + [("swing", d, float((-1) ** i)) for i, d in enumerate(days)]
    df = spark.createDataFrame(rows, "symbol string, ds date, ret double")
    steps = {(r.symbol, r.step): r for r in series_forecast(df, 2).collect()}
    assert steps["flat", 2].ar_order == 0 and steps["flat", 2].forecast == 3.0 == steps["flat", 2].lower
    # the second lag repeats the first one, so the orders end there
    assert steps["swing", 1].ar_order == 1 and np.isclose(steps["swing", 1].forecast, 1.0)
    assert series_forecast(df.where("ds < '2024-01-12'"), 2).count() == 0 and series_coefficients(df.limit(0)).count() == 0
