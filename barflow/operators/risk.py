"""Scenario and tail risk of multi-day returns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barflow.constants import (
    DRAWDOWN,
    SCENARIO_DAYS,
    SCENARIO_PATHS,
    SCENARIO_SCALE_CUT,
    SCENARIO_SEED,
    VAR_LEVEL,
)
from barflow.functions.checks import require_columns
from barflow.operators.quantiles import exact_quantiles
from barflow.operators.returns import rolling_return
from barflow.session import spread

_UNIT = 2.0**-52
PATHS_PER_BLOCK = 250


def student_t_draw(df: Column, *key: Column) -> Column:
    """A Student-t variate that is a function of ``key`` alone.

    Bailey's polar form needs two uniforms; both come from one digest of the key, so a retried
    task repeats its draws and every engine can recompute them.
    """
    digest = F.md5(F.concat_ws("|", *key))

    def uniform(start: int) -> Column:
        digits = F.conv(F.substring(digest, start, 13), 16, 10).cast("double")
        return (digits + 0.5) * F.lit(_UNIT)

    radius = F.sqrt(df * (F.pow(uniform(1), -2 / df) - 1))
    return radius * F.cos(F.lit(2.0) * F.lit(3.141592653589793) * uniform(14))


def scenario_paths(
    params: DataFrame,
    days: int = SCENARIO_DAYS,
    paths: int = SCENARIO_PATHS,
    scale_cut: float = SCENARIO_SCALE_CUT,
    seed: int = SCENARIO_SEED,
) -> DataFrame:
    """Final ``days``-day return of each simulated path, per symbol and scenario.

    ``params`` holds ``df, loc, scale`` per symbol. Blocks of paths are dealt over the cluster, so
    one symbol uses all of it; paths and days unfold inside a task and are summed there, without
    another shuffle. Both scenarios share their draws, as a common seed would give, and a path's
    draws are summed once for both.
    """
    require_columns(params, ["symbol", "df", "loc", "scale"])
    draw = student_t_draw(
        F.col("df"), F.lit(str(seed)), F.col("symbol"), F.col("path"), F.col("day")
    )
    block, last = F.col("block"), F.lit(paths)
    inside = F.sequence(block + 1, F.least(block + PATHS_PER_BLOCK, last))
    blocks = params.select("symbol", "df", "loc", "scale").withColumn(
        "block", F.explode(F.sequence(F.lit(0), last - 1, F.lit(PATHS_PER_BLOCK)))
    )
    summed = (
        spread(blocks, "symbol", "block")
        .withColumn("path", F.explode_outer(inside))
        .withColumn("day", F.explode(F.sequence(F.lit(1), F.lit(days))))
        .groupBy("symbol", "block", "path")
        .agg(F.sum(draw).alias("_t"), F.first("loc").alias("loc"), F.first("scale").alias("scale"))
    )
    scenarios = F.array(
        F.struct(F.lit("baseline").alias("name"), F.lit(1.0).alias("factor")),
        F.struct(F.lit("reduced").alias("name"), F.lit(1.0 - scale_cut).alias("factor")),
    )
    cumulative = F.col("loc") * days + F.col("scale") * F.col("s.factor") * F.col("_t")
    return summed.withColumn("s", F.explode(scenarios)).select(
        "symbol", F.col("s.name").alias("scenario"), "path", (F.exp(cumulative) - 1).alias("ret")
    )


def risk_numbers(
    df: DataFrame,
    by: tuple[str, ...] = ("symbol",),
    value: str = "ret",
    drawdown: float = DRAWDOWN,
    level: float = VAR_LEVEL,
) -> DataFrame:
    """Probability of a return below ``drawdown`` and the ``level`` quantile, per group.

    The quantile is selected exactly by passes over the values: see ``exact_quantiles``.
    """
    present = df.where(F.col(value).isNotNull())
    shares = present.groupBy(*by).agg(
        F.count(value).alias("n"),
        F.avg(F.when(F.col(value) < drawdown, 1.0).otherwise(0.0)).alias("prob_drawdown"),
    )
    limits = exact_quantiles(present, by, value, {"value_at_risk": level})
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in by]
    met = shares.alias("a").join(limits.alias("b"), same, "left")
    return met.select(*[F.col(f"a.{c}").alias(c) for c in by], "n", "prob_drawdown", "value_at_risk")


def scenario_risk(params: DataFrame, **options) -> DataFrame:
    """Risk numbers of the simulated scenarios; ``options`` go to ``scenario_paths``."""
    return risk_numbers(scenario_paths(params, **options), ("symbol", "scenario"))


def tail_risk(returns: DataFrame, days: int = SCENARIO_DAYS, value: str = "ret") -> DataFrame:
    """The same numbers on every observed run of ``days`` daily log returns."""
    return risk_numbers(rolling_return(returns, days, value))
