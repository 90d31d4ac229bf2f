import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from barflow.operators.eventstudy import (
    _medians,
    _weighted,
    impact_weights,
    anova_report,
    decision_anova,
    event_impacts,
    group_summary,
    levene,
    significance_flag,
)
from barflow.operators.macro import (
    decision_class,
    ensure_event_type,
    event_price_join,
    event_sentiment,
    flatten_macro,
    retag_source,
)
from conftest import rows_by


def test_decision_classes_and_sentiment(spark):
    rows = [("a", "2025-01-01", "2.0", "9", "1.0"), ("b", "2025-01-02", None, "1.0", "2.0"), ("c", "2025-01-03", "1", None, "1.0"),
            ("d", "2025-01-04", None, None, "1.0"), ("e", "2025-01-05", "bad", "3", None), ("f", "not a date", "1", "1", "2")]
    df = spark.createDataFrame(rows, "event_type string, event_date string, actual string, forecast string, previous string")
    got = {k: r.decision_class for k, r in rows_by(decision_class(df), "event_type").items()}
    assert got == {"a": "hike", "b": "cut", "c": "hold", "d": "unknown", "e": "unknown", "f": "cut"}
    signs = {k: r.event_sentiment for k, r in rows_by(event_sentiment(df), "event_type").items()}
    assert signs == {"a": -1, "b": 0, "c": 0, "d": 0, "e": 0, "f": 1}
    assert retag_source(decision_class(df)).where("source = 'macro_sentiment'").count() == 6


def test_flatten_fills_missing_extras(spark):
    df = spark.createDataFrame(
        [("cpi", "2025-01-15", "1.5", "x", None, ("14:00",))],
        "event_type string, event_date string, actual string, forecast string, previous string, extra struct<local_time_str:string>",
    )
    r = flatten_macro(df).head()
    assert (r.event_id, r.period_month, r.local_time_str) == ("cpi-2025-01-15", None, "14:00")
    assert (r.actual, r.forecast, r.event_year, r.event_month) == (1.5, None, 2025, 1)


def test_event_type_from_id(spark):
    df = spark.createDataFrame([("fed_rate-2025-01-01",), (None,)], "event_id string")
    assert [r.event_type for r in ensure_event_type(df).collect()] == ["fed_rate", "unknown"]
    assert ensure_event_type(df.withColumn("event_type", F.lit("x"))).select("event_type").distinct().count() == 1


def _brute(returns, events, mode, k, full):
    out, n = [], len(returns)
    index = {d: i for i, (d, _) in enumerate(returns)}
    values = [v for _, v in returns]
    for day, label in events:
        if day not in index or label == "unknown":
            continue
        i = index[day]
        if mode == "event_day":
            out.append((day, values[i]))
            continue
        window = range(i + 1, i + k + 1) if mode == "post_k_days" else range(i - k, i)
        inside = [j for j in window if 0 <= j < n]
        if full and len(inside) < k:
            continue
        inside = inside or [i]
        out.append((day, float(np.prod([1 + values[j] for j in inside]) - 1)))
    return sorted(out)


@pytest.mark.parametrize("mode", ["event_day", "post_k_days", "pre_k_days"])
@pytest.mark.parametrize("full", [True, False])
@pytest.mark.parametrize("k", [1, 3, 40])
def test_impacts_match_brute_force(spark, mode, full, k):
    rng = np.random.default_rng(k)
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=int(i)) for i in sorted(rng.choice(60, 30, replace=False))]
    returns = [(d, float(v)) for d, v in zip(days, rng.normal(0, 0.05, 30))]
    events = [(d, c) for d, c in zip([days[0], days[1], days[10], days[-2], days[-1], dt.date(2030, 1, 1), days[5]],
                                     ["hike", "cut", "hold", "hike", "cut", "hold", "unknown"])]
    r = spark.createDataFrame([("A", d, v) for d, v in returns], "symbol string, ds date, ret double")
    e = spark.createDataFrame([(d, c, 0.1, 1.0) for d, c in events], "event_date date, decision_class string, delta double, rate double")
    got = sorted((x.event_date, x.impact) for x in event_impacts(e, r, mode, k, full).collect())
    want = _brute(returns, events, mode, k, full)
    assert [d for d, _ in got] == [d for d, _ in want]
    assert np.allclose([v for _, v in got], [v for _, v in want])


def test_unknown_mode(spark, series):
    e = spark.createDataFrame([], "event_date date, decision_class string, delta double, rate double")
    with pytest.raises(ValueError):
        event_impacts(e, series[0], "sideways")
    with pytest.raises(ValueError):
        event_impacts(e, series[0], "post_k_days", 0)


def _f_test(groups):
    everything = np.concatenate(groups)
    between = sum(len(g) * (g.mean() - everything.mean()) ** 2 for g in groups)
    within = sum(((g - g.mean()) ** 2).sum() for g in groups)
    d1, d2 = len(groups) - 1, len(everything) - len(groups)
    return (between / d1) / (within / d2), d1, d2


def test_anova_and_levene_match_numpy(spark):
    rng = np.random.default_rng(3)
    groups = {"hike": rng.normal(0.1, 1, 12), "cut": rng.normal(0.9, 2, 15), "hold": np.array([4.0])}
    rows = [("A", g, float(v)) for g, a in groups.items() for v in a] + [("B", "hike", 1.0), ("B", "cut", 2.0), ("B", "cut", 3.0)]
    df = spark.createDataFrame(rows, "symbol string, group string, impact double")
    got = decision_anova(df).collect()
    assert [r.symbol for r in got] == ["A"]  # B has one testable class only
    r = got[0]
    f, d1, d2 = _f_test([groups["hike"], groups["cut"]])
    assert np.isclose(r.f_stat, f) and (r.dof_between, r.dof_within) == (d1, d2)
    assert r.levels == ["hike", "cut"] and r.group_sizes == [12, 15]
    all_values = np.concatenate(list(groups.values()))
    between = sum(len(groups[g]) * (groups[g].mean() - all_values.mean()) ** 2 for g in ("hike", "cut"))
    assert np.isclose(r.eta2, between / ((all_values - all_values.mean()) ** 2).sum())
    # Two groups: F is the square of the pooled t statistic, checked by integration.
    t = np.linspace(np.sqrt(f), 200, 2_000_001)
    from math import lgamma, log, pi, exp

    constant = exp(lgamma((d2 + 1) / 2) - lgamma(d2 / 2) - 0.5 * log(d2 * pi))
    tail = np.trapezoid(constant * (1 + t * t / d2) ** (-(d2 + 1) / 2), t)
    assert np.isclose(r.p_value, 2 * tail, atol=1e-6)
    lf, _, _ = _f_test([np.abs(groups[g] - np.median(groups[g])) for g in ("hike", "cut")])
    assert np.isclose(levene(df).head().levene_stat, lf)
    report = anova_report(df).head()
    assert report.verdict == ("no difference" if r.p_value >= 0.05 else "difference")
    assert significance_flag(decision_anova(df), alpha=0.0).head().verdict == "no difference"
    summary = {(x.symbol, x.group): x for x in group_summary(df).collect()}
    assert summary["A", "hold"].std is None and np.isclose(summary["A", "cut"].std, groups["cut"].std(ddof=1))


def test_event_price_join_keeps_events_without_prices(spark):
    events = spark.createDataFrame([("x", dt.date(2025, 1, 1)), ("y", dt.date(2025, 1, 2))], "event_type string, event_date date")
    candles = spark.createDataFrame([(dt.date(2025, 1, 1), "A", 1.0), (dt.date(2025, 1, 1), "B", 2.0)], "day date, symbol string, close double")
    rows = event_price_join(events, candles).collect()
    assert len(rows) == 3 and sum(r.symbol is None for r in rows) == 1


def test_weights_stand_for_repeated_events(spark):
    rng = np.random.default_rng(11)
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(60)]
    returns = spark.createDataFrame([(s, d, float(rng.normal())) for s in "AB" for d in days], "symbol string, ds date, ret double")
    classes = ["cut", "hold", "hike", "other"]
    events = [(days[int(rng.integers(0, 60))], classes[int(rng.integers(0, 4))], 0.0, 0.0) for _ in range(400)]
    events += [(days[5], "cut", 0.0, 0.0)] * 300 + [(None, "cut", 0.0, 0.0), (days[7], None, 0.0, 0.0)]
    df = spark.createDataFrame(events, "event_date date, decision_class string, delta double, rate double")
    each, counted = event_impacts(df, returns), impact_weights(df, returns)
    assert counted.count() < each.count() / 2 and counted.agg({"weight": "sum"}).head()[0] == each.count()
    rows = each.toPandas()
    for summary in (group_summary(each), group_summary(counted)):
        got = {(r["symbol"], r["group"]): r for r in summary.collect()}
        for key, part in rows.groupby(["symbol", "group"]):
            assert got[key]["count"] == len(part)
            assert np.allclose([got[key]["mean"], got[key]["std"]], [part.impact.mean(), part.impact.std()])
    for test in (decision_anova, levene, anova_report):
        a, b = ({r["symbol"]: r.asDict() for r in test(x).collect()} for x in (each, counted))
        assert a.keys() == b.keys() and a
        for symbol in a:
            for column, value in a[symbol].items():
                other = b[symbol][column]
                assert value == other or np.allclose(value, other), (test.__name__, column)
    medians = {(r["symbol"], r["group"]): r["_centre"] for r in _medians(_weighted(counted)).collect()}
    assert all(np.isclose(medians[key], part.impact.median()) for key, part in rows.groupby(["symbol", "group"]))


def test_events_are_counted_below_the_join(spark):
    returns = spark.createDataFrame([("A", dt.date(2024, 1, 1), 0.1)], "symbol string, ds date, ret double")
    df = spark.createDataFrame([(dt.date(2024, 1, 1), "cut", 0.0, 0.0)], "event_date date, decision_class string, delta double, rate double")
    plan = impact_weights(df, returns, "event_day")._jdf.queryExecution().optimizedPlan().toString()
    join = plan[plan.index("Join Inner"):]
    assert "Aggregate [event_date" in join and "count(1)" in join
    assert impact_weights(df.limit(0), returns).count() == 0 and decision_anova(impact_weights(df, returns.limit(0))).count() == 0
