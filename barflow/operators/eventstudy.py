"""Event study: returns around dated decisions and tests between decision classes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barflow.constants import DECISION_CLASSES, SIGNIFICANCE
from barflow.functions.checks import require_columns
from barflow.functions.numerics import f_sf
from barflow.operators.bars import dedup_dates
from barflow.operators.returns import by_date

MODES = ("event_day", "post_k_days", "pre_k_days")


def event_day_join(events: DataFrame, returns: DataFrame) -> DataFrame:
    """Classified events with the return of the same date; the others are dropped."""
    return events.join(returns, events["event_date"] == returns["ds"]).drop("ds")


def _window_return(mode: str, k: int, require_full_window: bool, value: str) -> Column:
    """Compounded return around each row of a series, or null where the window does not count."""
    first, last = (1, k) if mode == "post_k_days" else (-k, -1)
    frame = by_date().rowsBetween(first, last)
    compounded = F.product(F.lit(1.0) + F.col(value)).over(frame) - 1
    present = F.count(value).over(frame)
    if require_full_window:
        return F.when(present == k, compounded)
    # A clamped window is never empty: at the end of the series it is the event's own day.
    return F.when(present == 0, F.col(value)).otherwise(compounded)


def series_impacts(
    returns: DataFrame,
    mode: str = "post_k_days",
    k: int = 3,
    require_full_window: bool = True,
    value: str = "ret",
    order: Sequence[str] = (),
) -> DataFrame:
    """The impact an event on each date of each series would have.

    Of several rows on a date the first by ``order`` counts, then the smallest value.
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}; use one of {MODES}")
    if k < 1:
        raise ValueError("k must be at least 1")
    # the aggregate needs no exchange of its own where the series is dealt by symbol already
    present = returns.where(F.col(value).isNotNull())
    series = dedup_dates(present, value, "first", (*order, value))
    impact = (
        F.col(value)
        if mode == "event_day"
        else _window_return(mode, k, require_full_window, value)
    )
    return series.select("symbol", "ds", impact.alias("impact")).where(
        F.col("impact").isNotNull()
    )


def event_impacts(
    events: DataFrame,
    returns: DataFrame,
    mode: str = "post_k_days",
    k: int = 3,
    require_full_window: bool = True,
    value: str = "ret",
    order: Sequence[str] = (),
) -> DataFrame:
    """Impact per symbol and classified event: ``symbol, event_date, group, impact, delta, rate``.

    ``post_k_days`` and ``pre_k_days`` compound the ``k`` rows after or before the event. With
    ``require_full_window`` events lacking some of them are dropped, otherwise the window is
    clamped to the series. ``returns`` should hold one row per symbol and date; of several the first by
    ``order`` counts. Log returns reproduce
    the published numbers, simple returns compound exactly.
    """
    require_columns(events, ["event_date", "decision_class", "delta", "rate"])
    known = events.where(F.col("decision_class").isin(*DECISION_CLASSES))
    measured = series_impacts(returns, mode, k, require_full_window, value, order)
    return event_day_join(known, measured).select(
        "symbol",
        "event_date",
        F.col("decision_class").alias("group"),
        "impact",
        "delta",
        "rate",
    )


def impact_weights(
    events: DataFrame,
    returns: DataFrame,
    mode: str = "post_k_days",
    k: int = 3,
    require_full_window: bool = True,
    value: str = "ret",
    order: Sequence[str] = (),
) -> DataFrame:
    """``symbol, event_date, group, impact, weight``: each impact once, with the number of its events.

    An impact depends on symbol and date only, so events are counted per date and class before they meet the
    series: what is joined is bounded by dates and classes, not by events. ``group_summary``,
    ``decision_anova``, ``levene`` and ``anova_report`` take these rows and those of ``event_impacts`` alike.
    """
    require_columns(events, ["event_date", "decision_class"])
    known = events.where(F.col("decision_class").isin(*DECISION_CLASSES))
    counted = known.groupBy("event_date", "decision_class").agg(F.count(F.lit(1)).alias("weight"))
    measured = series_impacts(returns, mode, k, require_full_window, value, order)
    return event_day_join(counted, measured).select(
        "symbol", "event_date", F.col("decision_class").alias("group"), "impact", "weight"
    )


def _weighted(impacts: DataFrame) -> DataFrame:
    """``symbol, group, impact, weight``; without a weight a row counts once. Null impacts do not count."""
    weight = F.col("weight") if "weight" in impacts.columns else F.lit(1)
    rows = impacts.select("symbol", "group", "impact", weight.cast("bigint").alias("weight"))
    return rows.where(F.col("impact").isNotNull() & (F.col("weight") > 0))


def _moments(rows: DataFrame, value: Column) -> DataFrame:
    """``symbol, group, n, mean, ss`` of a value that counts ``weight`` times.

    Rows of one weight share Spark's own mergeable moments; those of the weights, a few lines a
    group, are merged by the rule for parts: ss = sum of ss_i + sum of n_i * (mean_i - mean)**2.
    """
    times = F.col("weight")
    parts = rows.groupBy("symbol", "group", "weight").agg(
        (F.count(value) * times).alias("n"),
        F.avg(value).alias("mean"),
        (F.var_pop(value) * F.count(value) * times).alias("ss"),
    )
    whole = Window.partitionBy("symbol", "group")
    mean = F.sum(F.col("n") * F.col("mean")).over(whole) / F.sum("n").over(whole)
    off = F.col("n") * F.pow(F.col("mean") - F.col("_all"), F.lit(2))
    return (
        parts.withColumn("_all", mean)
        .groupBy("symbol", "group")
        .agg(F.sum("n").alias("n"), F.first("_all").alias("mean"), F.sum(F.col("ss") + off).alias("ss"))
    )


def _medians(rows: DataFrame) -> DataFrame:
    """``symbol, group, _centre``: the median of impacts that count ``weight`` times.

    Equal impacts are merged first; the running weight of a group is a window over one line per
    distinct impact, at most one a calendar date.
    """
    merged = rows.groupBy("symbol", "group", "impact").agg(F.sum("weight").alias("weight"))
    whole = Window.partitionBy("symbol", "group")
    running = F.sum("weight").over(whole.orderBy("impact").rowsBetween(Window.unboundedPreceding, 0))
    placed = merged.withColumns({"_up_to": running, "_n": F.sum("weight").over(whole)})

    def at(rank: Column) -> Column:
        return F.min(F.when(F.col("_up_to") > rank, F.col("impact")))

    low, high = F.floor((F.col("_n") - 1) / 2), F.ceil((F.col("_n") - 1) / 2)
    return placed.groupBy("symbol", "group").agg(((at(low) + at(high)) / 2).alias("_centre"))


def group_summary(impacts: DataFrame) -> DataFrame:
    """Count, mean and sample deviation of the impact per symbol and class that has one."""
    found = _moments(_weighted(impacts), F.col("impact"))
    deviation = F.when(F.col("n") > 1, F.sqrt(F.col("ss") / (F.col("n") - 1)))
    return found.select("symbol", "group", F.col("n").alias("count"), "mean", deviation.alias("std"))


def _one_way(groups: DataFrame) -> DataFrame:
    """F test from ``n, mean, ss`` per symbol and group; groups under two members do not count.

    The grand mean of ``eta2`` covers every group, that of F only those tested.
    """
    whole = Window.partitionBy("symbol")
    tested = F.col("n") >= 2
    size = F.when(tested, F.col("n"))
    grand_all = F.sum(F.col("n") * F.col("mean")).over(whole) / F.sum("n").over(whole)
    grand = F.sum(size * F.col("mean")).over(whole) / F.sum(size).over(whole)
    off_all = F.pow(F.col("mean") - F.col("_grand_all"), F.lit(2))
    off = F.pow(F.col("mean") - F.col("_grand"), F.lit(2))
    position = F.array_position(F.array(*[F.lit(c) for c in DECISION_CLASSES]), F.col("group"))
    level = F.when(tested, F.struct(position.alias("at"), "group", "n", "mean"))
    summed = (
        groups.withColumns({"_grand_all": grand_all, "_grand": grand})
        .groupBy("symbol")
        .agg(
            F.count_if(tested).alias("k"),
            F.sum(size).alias("n"),
            F.sum(size * off).alias("ss_between"),
            F.sum(F.when(tested, F.col("ss"))).alias("ss_within"),
            F.sum(size * off_all).alias("_between_all"),
            F.sum(F.col("ss") + F.col("n") * off_all).alias("_total"),
            F.sort_array(F.collect_list(level)).alias("_levels"),
        )
        .where((F.col("k") >= 2) & (F.col("n") > F.col("k")))
    )
    ms_within = F.col("ss_within") / F.col("dof_within")
    return (
        summed.withColumns({"dof_between": F.col("k") - 1, "dof_within": F.col("n") - F.col("k")})
        .withColumn(
            "f_stat", F.try_divide(F.col("ss_between") / F.col("dof_between"), ms_within)
        )
        .withColumn("eta2", F.try_divide(F.col("_between_all"), F.col("_total")))
        .withColumn(
            "p_value",
            f_sf(
                F.col("f_stat"),
                F.col("dof_between").cast("double"),
                F.col("dof_within").cast("double"),
            ),
        )
        .select(
            "symbol",
            F.col("_levels.group").alias("levels"),
            F.col("_levels.n").alias("group_sizes"),
            F.col("_levels.mean").alias("group_means"),
            "dof_between",
            "dof_within",
            "f_stat",
            "p_value",
            "eta2",
        )
    )


def decision_anova(impacts: DataFrame) -> DataFrame:
    """One-way analysis of variance of the impact over the classes, per symbol.

    Needs two classes with at least two events each; other symbols have no row.
    """
    return _one_way(_moments(_weighted(impacts), F.col("impact")))


def levene(impacts: DataFrame) -> DataFrame:
    """Levene's test with median centres: an F test of the distances from the class median."""
    rows = _weighted(impacts)
    centred = rows.join(_medians(rows), ["symbol", "group"])
    groups = _moments(centred, F.abs(F.col("impact") - F.col("_centre")))
    return _one_way(groups).select(
        "symbol", F.col("f_stat").alias("levene_stat"), F.col("p_value").alias("levene_p_value")
    )


def anova_report(impacts: DataFrame, alpha: float = SIGNIFICANCE) -> DataFrame:
    """F test, Levene's test and the verdict, one row per symbol."""
    tests = decision_anova(impacts).join(levene(impacts), "symbol", "left")
    return significance_flag(tests, alpha)


def significance_flag(anova: DataFrame, alpha: float = SIGNIFICANCE) -> DataFrame:
    """``verdict``: whether the class means differ at level ``alpha``."""
    verdict = F.when(F.col("p_value") >= alpha, "no difference").otherwise("difference")
    return anova.withColumn("verdict", F.when(F.col("p_value").isNotNull(), verdict))
