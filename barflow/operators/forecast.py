"""Forecasts of daily series and their errors."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import date

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barflow.constants import MIN_FORECAST_HISTORY
from barflow.functions.arsolve import best_orders, forecast_steps, p_values
from barflow.functions.checks import require_columns, require_date
from barflow.functions.recursive import HistoryFitter, IncrementalFitter, is_incremental
from barflow.functions.timecols import as_date
from barflow.operators.bars import forecast_calendar
from barflow.operators.returns import by_date, lag_design
from barflow.schemas import FORECAST_SCHEMA
from barflow.session import spread

Fitter = Callable[["pd.Series"], "float | None"]
SeriesFitter = Callable[["pd.Series", int], "list[tuple[float, float, float]]"]


def _targets(df: DataFrame, start: str | date, end: str | date) -> DataFrame:
    days = F.sequence(F.lit(as_date(start)), F.lit(as_date(end)))
    return df.select("symbol").distinct().withColumn("ds", F.explode(days))


def ar1_walk_forward(
    df: DataFrame,
    start: str | date | None = None,
    end: str | date | None = None,
    value: str = "close",
    min_history: int = MIN_FORECAST_HISTORY,
) -> DataFrame:
    """One-step forecasts for every target date, each from a refit on the dates before it.

    The refits are regression aggregates over an expanding frame, so a symbol costs one ordered
    pass instead of one fit per date. Targets are the calendar dates of [start, end], with or
    without an actual value; without bounds they are the observed dates.
    """
    require_columns(df, ["symbol", "ds", value])
    require_date(df, "ds")
    series = df.where(F.col(value).isNotNull()).select("symbol", "ds", F.col(value).alias("y"))
    if start is None or end is None:
        rows = series.withColumn("target", F.lit(True))
        if start is not None:
            rows = rows.withColumn("target", F.col("ds") >= F.lit(as_date(start)))
        if end is not None:
            rows = rows.where(F.col("ds") <= F.lit(as_date(end)))
    else:
        asked = _targets(series, start, end).select(
            "symbol", "ds", F.lit(None).cast("double").alias("y"), F.lit(True).alias("target")
        )
        history = series.where(F.col("ds") <= F.lit(as_date(end)))
        rows = (
            history.withColumn("target", F.lit(False))
            .unionByName(asked)
            .groupBy("symbol", "ds")
            .agg(F.max("y").alias("y"), F.max("target").alias("target"))
        )
    before = by_date().rowsBetween(Window.unboundedPreceding, -1)
    known = rows.withColumn("prev", F.last("y", ignorenulls=True).over(before))
    fitted = known.withColumns(
        {
            "slope": F.regr_slope("y", "prev").over(before),
            "intercept": F.regr_intercept("y", "prev").over(before),
            "history": F.count("y").over(before),
        }
    )
    y_hat = F.col("intercept") + F.col("slope") * F.col("prev")
    return (
        fitted.where(F.col("target") & (F.col("history") >= min_history))
        .select("symbol", "ds", y_hat.alias("y_hat_close"))
        .where(F.col("y_hat_close").isNotNull())
    )


def forecast_next_day(
    df: DataFrame, fitter: Fitter | None = None, value: str = "close"
) -> DataFrame:
    """One forecast per symbol, for the day after its last date; needs ten observations.

    Without a ``fitter`` this is the lag regression of the last refit, in aggregates only. A
    fitter gets one symbol's daily series, which the calendar bounds, and returns the next value.
    """
    require_date(df, "ds")
    series = df.where(F.col(value).isNotNull())
    if fitter is not None:
        groups = spread(series.select("symbol", "ds", value), "symbol").groupBy("symbol")
        return groups.applyInPandas(_next_day_group(fitter, value), FORECAST_SCHEMA)
    pairs = series.withColumn("prev", F.lag(value).over(by_date()))
    fit = pairs.groupBy("symbol").agg(
        F.count(value).alias("history"),
        F.regr_slope(value, "prev").alias("slope"),
        F.regr_intercept(value, "prev").alias("intercept"),
        F.max_by(value, "ds").alias("last"),
        F.date_add(F.max("ds"), 1).alias("ds"),
    )
    y_hat = F.col("intercept") + F.col("slope") * F.col("last")
    return (
        fit.where(F.col("history") >= MIN_FORECAST_HISTORY)
        .select("symbol", "ds", y_hat.alias("y_hat_close"))
        .where(F.col("y_hat_close").isNotNull())
    )


def _next_day_group(fitter: Fitter, value: str):
    minimum = MIN_FORECAST_HISTORY

    def run(pdf):
        import pandas as pd

        pdf = pdf.sort_values("ds")
        y_hat = fitter(pdf[value].reset_index(drop=True)) if len(pdf) >= minimum else None
        rows = []
        if y_hat is not None:
            following = pd.Timestamp(pdf["ds"].iloc[-1]) + pd.Timedelta(days=1)
            rows.append((pdf["symbol"].iloc[0], following.date(), float(y_hat)))
        return pd.DataFrame(rows, columns=["symbol", "ds", "y_hat_close"])

    return run


def forecast_period(
    df: DataFrame,
    start: str | date,
    end: str | date,
    fitter: Fitter | IncrementalFitter | None = None,
    value: str = "close",
    targets_per_task: int | None = None,
    min_history: int = MIN_FORECAST_HISTORY,
) -> DataFrame:
    """Walk-forward forecasts for each calendar date of [start, end].

    Without a ``fitter`` this is ``ar1_walk_forward``. With one, a symbol is one ordered pass: its
    values and target dates reach Python once each, in order of date and a batch at a time, and only the
    fitter's state is kept. Besides incremental fitters (``functions.recursive``), such as
    ``RecursiveLeastSquares``, a plain function of the series so far is taken; its state is that series.

    ``targets_per_task`` is for plain functions that take long: blocks of so many target dates become
    tasks of their own, each with a copy of the symbol's series.

    A target sees the values of the dates before it; it has no row with fewer than ``min_history`` of
    them, nor where the fitter gives None. Null and NaN values are no history.
    """
    first, last = as_date(start), as_date(end)
    if last < first:
        raise ValueError("end must not be before start")
    if fitter is None:
        return ar1_walk_forward(df, first, last, value, min_history)
    require_columns(df, ["symbol", "ds", value])
    require_date(df, "ds")
    rows = walk_rows(df, first, last, value)
    if targets_per_task is not None:
        if is_incremental(fitter):
            raise ValueError("an incremental fitter takes one pass; leave out targets_per_task")
        blocks = range(0, (last - first).days + 1, targets_per_task)
        copies = rows.where("target = 1").select("symbol", "ds", F.col("y").alias(value))
        dealt = copies.withColumn("block", F.explode(F.array(*[F.lit(b) for b in blocks])))
        group = _period_group(fitter, value, first, last, targets_per_task, min_history)
        return spread(dealt, "symbol", "block").groupBy("symbol", "block").applyInPandas(group, FORECAST_SCHEMA)
    ordered = spread(rows, "symbol").sortWithinPartitions("symbol", "ds", "target")
    steps = fitter if is_incremental(fitter) else HistoryFitter(fitter)
    return ordered.mapInPandas(_ordered_pass(steps, min_history), FORECAST_SCHEMA)


def walk_rows(df: DataFrame, first: date, last: date, value: str) -> DataFrame:
    """Values before ``last`` and the target dates of each symbol; on a date the target (0) comes first."""
    y = F.col(value).cast("double")
    known = df.where(y.isNotNull() & ~F.isnan(y) & (F.col("ds") < F.lit(last)))
    values = known.select("symbol", "ds", F.lit(1).alias("target"), y.alias("y"))
    asked = _targets(values, first, last)
    return values.unionByName(asked.select("symbol", "ds", F.lit(0).alias("target"), F.lit(None).cast("double").alias("y")))


def _ordered_pass(fitter: IncrementalFitter, minimum: int):
    def run(batches):
        import pandas as pd

        symbol, state, seen = None, None, 0
        for pdf in batches:
            rows = []
            for name, day, is_value, y in zip(pdf["symbol"], pdf["ds"], pdf["target"], pdf["y"]):
                if state is None or name != symbol:
                    symbol, state, seen = name, fitter.start(), 0
                if is_value:
                    state, seen = fitter.update(state, float(y)), seen + 1
                elif seen >= minimum:
                    y_hat = fitter.forecast(state)
                    if y_hat is not None:
                        rows.append((name, day, float(y_hat)))
            if rows:
                yield pd.DataFrame(rows, columns=["symbol", "ds", "y_hat_close"])

    return run


def _period_group(fitter: Fitter, value: str, first: date, last: date, size: int, minimum: int):
    def run(pdf):
        import pandas as pd

        pdf = pdf.sort_values("ds")
        days = pd.to_datetime(pdf["ds"])
        begin = pd.Timestamp(first) + pd.Timedelta(days=int(pdf["block"].iloc[0]))
        rows = []
        for target in pd.date_range(begin, min(begin + pd.Timedelta(days=size - 1), pd.Timestamp(last))):
            history = pdf.loc[days < target, value].reset_index(drop=True)
            y_hat = fitter(history) if len(history) >= minimum else None
            if y_hat is not None:
                rows.append((pdf["symbol"].iloc[0], target.date(), float(y_hat)))
        return pd.DataFrame(rows, columns=["symbol", "ds", "y_hat_close"])

    return run


def forecast_errors(forecasts: DataFrame, actuals: DataFrame, value: str = "close") -> DataFrame:
    """Forecasts with the actual value, absolute and relative error; all null without an actual."""
    known = actuals.select("symbol", "ds", F.col(value).alias("actual_close"))
    gap = F.abs(F.col("y_hat_close") - F.col("actual_close"))
    return forecasts.join(known, ["symbol", "ds"], "left").withColumns(
        {"abs_error": gap, "ape": F.abs(F.try_divide(gap, F.col("actual_close")))}
    )


# --- autoregression with a chosen order -------------------------------------


def _cross_products(df: DataFrame, value: str, max_order: int, min_rows: int) -> DataFrame:
    """Means and centred sums of products of (lags, value) per symbol, and its newest values."""
    lags = [f"lag{i}" for i in range(1, max_order + 1)]
    design = [*lags, value]
    pairs = [(i, j) for i in range(len(design)) for j in range(i, len(design))]
    sums = [(F.covar_pop(design[i], design[j]) * F.count(F.lit(1))).alias(f"s_{i}_{j}") for i, j in pairs]
    means = [F.avg(c).alias(f"mean_{i}") for i, c in enumerate(design)]
    newest = [F.max_by(c, "ds").alias(f"recent_{k}") for k, c in enumerate([value, *lags[:-1]])]
    return (
        lag_design(df, value, max_order)
        .groupBy("symbol")
        .agg(F.count(F.lit(1)).alias("n"), *means, *sums, *newest)
        .where(F.col("n") >= min_rows)
    )


def _solved(pdf: "pd.DataFrame", max_order: int):
    """The fits of a batch of symbols, and their newest values."""
    size = max_order + 1
    cross = np.empty((len(pdf), size, size))
    for i in range(size):
        for j in range(i, size):
            cross[:, i, j] = cross[:, j, i] = pdf[f"s_{i}_{j}"].to_numpy(float)
    means = pdf[[f"mean_{i}" for i in range(size)]].to_numpy(float)
    recent = pdf[[f"recent_{k}" for k in range(max_order)]].to_numpy(float)
    return best_orders(pdf["n"].to_numpy(float), means, cross), recent


def series_forecast(
    df: DataFrame,
    horizon: int = 7,
    max_order: int = 5,
    value: str = "ret",
    fitter: SeriesFitter | None = None,
) -> DataFrame:
    """``horizon`` steps of the autoregression with the smallest AIC, with 95 % limits.

    The data is reduced to means and centred sums of products per symbol in one aggregation; only
    those few numbers reach Python, a batch of symbols at a time. Needs ten usable rows.

    A ``fitter`` replaces the autoregression: it gets one symbol's daily series and the horizon and
    returns one ``(forecast, lower, upper)`` per step; order and AIC are then null.
    """
    if not 1 <= horizon:
        raise ValueError("horizon must be at least 1")
    if fitter is not None:
        return _fitted_steps(df, horizon, value, fitter)
    table = _cross_products(df, value, max_order, MIN_FORECAST_HISTORY)

    def run(batches: Iterator) -> Iterator:
        for pdf in batches:
            if not len(pdf):
                continue
            fit, recent = _solved(pdf, max_order)
            means, halves = forecast_steps(fit, recent, horizon)
            yield pd.DataFrame(
                {
                    "symbol": np.repeat(pdf["symbol"].to_numpy(), horizon),
                    "ar_order": np.repeat(fit.order, horizon),
                    "aic": np.repeat(fit.aic, horizon),
                    "step": np.tile(np.arange(1, horizon + 1), len(pdf)),
                    "forecast": means.ravel(),
                    "lower": (means - halves).ravel(),
                    "upper": (means + halves).ravel(),
                }
            )

    steps = table.mapInPandas(
        run, "symbol string, ar_order int, aic double, step int, forecast double, lower double, upper double"
    )
    calendar = forecast_calendar(df.where(F.col(value).isNotNull()), horizon)
    return calendar.join(steps, ["symbol", "step"])


def _fitted_steps(df: DataFrame, horizon: int, value: str, fitter: SeriesFitter) -> DataFrame:
    require_date(df, "ds")
    minimum = MIN_FORECAST_HISTORY

    def run(pdf):
        import pandas as pd

        columns = ["symbol", "step", "forecast", "lower", "upper"]
        if len(pdf) < minimum:
            return pd.DataFrame([], columns=columns)
        pdf = pdf.sort_values("ds")
        steps = fitter(pdf[value].reset_index(drop=True), horizon)
        symbol = pdf["symbol"].iloc[0]
        rows = [(symbol, i, *map(float, step)) for i, step in enumerate(steps, start=1)]
        return pd.DataFrame(rows, columns=columns)

    series = df.where(F.col(value).isNotNull()).select("symbol", "ds", value)
    steps = spread(series, "symbol").groupBy("symbol").applyInPandas(
        run, "symbol string, step int, forecast double, lower double, upper double"
    )
    return (
        forecast_calendar(series, horizon)
        .join(steps, ["symbol", "step"])
        .select(
            "symbol",
            "step",
            "ds",
            F.lit(None).cast("int").alias("ar_order"),
            F.lit(None).cast("double").alias("aic"),
            "forecast",
            "lower",
            "upper",
        )
    )


def series_coefficients(df: DataFrame, max_order: int = 5, value: str = "ret") -> DataFrame:
    """Coefficients and p-values of the chosen autoregression."""
    table = _cross_products(df, value, max_order, MIN_FORECAST_HISTORY)
    terms = np.array(["const", *[f"lag{i}" for i in range(1, max_order + 1)]])

    def run(batches: Iterator) -> Iterator:
        for pdf in batches:
            if not len(pdf):
                continue
            fit, _ = _solved(pdf, max_order)
            at, term = np.nonzero(np.arange(max_order + 1) <= fit.order[:, None])
            p = p_values(fit)[at, term]
            yield pd.DataFrame(
                {
                    "symbol": pdf["symbol"].to_numpy()[at],
                    "ar_order": fit.order[at],
                    "term": terms[term],
                    "estimate": np.column_stack([fit.constant, fit.slopes])[at, term],
                    "p_value": np.where(np.isnan(p), None, p),
                }
            )

    return table.mapInPandas(run, "symbol string, ar_order int, term string, estimate double, p_value double")
