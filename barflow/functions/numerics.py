"""Distribution functions Spark SQL does not have.

Normal probabilities are column expressions and stay in generated code. The incomplete
gamma and beta functions need iteration; they are small numpy helpers behind pandas UDFs.
The module is shipped to the workers by value, so executors need no installed package.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rational approximation of the normal tail (Hart 1968, in West's double-precision form).
# Fixed values, highest power first.
_TAIL_NUMERATOR = (
    3.52624965998911e-02, 0.700383064443688, 6.37396220353165, 33.912866078383,
    112.079291497871, 221.213596169931, 220.206867912376,
)
_TAIL_DENOMINATOR = (
    8.83883476483184e-02, 1.75566716318264, 16.064177579207, 86.7807322029461,
    296.564248779674, 637.333633378831, 793.826512519948, 440.413735824752,
)


def _horner(coefficients, x: Column) -> Column:
    value = F.lit(coefficients[0])
    for c in coefficients[1:]:
        value = value * x + F.lit(c)
    return value


def normal_sf(z: Column) -> Column:
    """P(Z > z) as a column expression, about 15 digits."""
    a = F.abs(z)
    density = F.exp(-a * a / 2)
    near = density * _horner(_TAIL_NUMERATOR, a) / _horner(_TAIL_DENOMINATOR, a)
    fraction = a + F.lit(0.65)
    for k in (4, 3, 2, 1):
        fraction = a + F.lit(float(k)) / fraction
    far = density / fraction / F.lit(math.sqrt(2 * math.pi))
    upper = F.when(a > 37, F.lit(0.0)).when(a < 7.07106781186547, near).otherwise(far)
    return F.when(z >= 0, upper).otherwise(1 - upper)


def normal_cdf(z: Column) -> Column:
    return normal_sf(-z)


def normal_ppf(p: Column) -> Column:
    """Normal quantile as a column expression: a rational start (Abramowitz and Stegun 26.2.23) for the
    smaller tail and two Newton steps on ``normal_sf``, about 12 digits. NaN outside (0, 1)."""
    tail = F.least(p, 1 - p)
    t = F.sqrt(-2 * F.ln(tail))
    top = F.lit(2.515517) + t * (F.lit(0.802853) + t * F.lit(0.010328))
    bottom = F.lit(1.0) + t * (F.lit(1.432788) + t * (F.lit(0.189269) + t * F.lit(0.001308)))
    z = t - top / bottom

    def newton(at: Column) -> Column:
        return at + (normal_sf(at) - tail) * F.lit(math.sqrt(2 * math.pi)) * F.exp(at * at / 2)

    for _ in range(2):
        # the one-element array makes the value a variable, so it is computed once
        z = F.get(F.transform(F.array(z), newton), F.lit(0))
    inside = F.when(p < 0.5, -z).otherwise(z)
    return F.when((p > 0) & (p < 1), inside).otherwise(F.lit(math.nan))


def normal_pdf(x: Column, mu: Column, sigma: Column) -> Column:
    z = (x - mu) / sigma
    return F.exp(-z * z / 2) / (sigma * F.lit(math.sqrt(2 * math.pi)))


def digamma_sql(x: str) -> str:
    """Digamma for x > 0 as SQL: recurrence up to x + 10, then the asymptotic series."""
    y = f"({x} + 10)"
    shift = " ".join(f"- 1 / ({x} + {j})" for j in range(10))
    series = (
        f"ln({y}) - 1 / (2 * {y}) - 1 / (12 * pow({y}, 2)) + 1 / (120 * pow({y}, 4)) "
        f"- 1 / (252 * pow({y}, 6)) + 1 / (240 * pow({y}, 8)) - 1 / (132 * pow({y}, 10))"
    )
    return f"({series} {shift})"


def trigamma_sql(x: str) -> str:
    """Derivative of digamma for x > 0 as SQL, by the same scheme."""
    y = f"({x} + 10)"
    shift = " ".join(f"+ 1 / pow({x} + {j}, 2)" for j in range(10))
    series = (
        f"1 / {y} + 1 / (2 * pow({y}, 2)) + 1 / (6 * pow({y}, 3)) - 1 / (30 * pow({y}, 5)) "
        f"+ 1 / (42 * pow({y}, 7)) - 1 / (30 * pow({y}, 9)) + 5 / (66 * pow({y}, 11))"
    )
    return f"({series} {shift})"


# --- numpy helpers ---------------------------------------------------------


def _lgamma(x: np.ndarray) -> np.ndarray:
    """ln Γ(x) for x > 0; shape parameters repeat, so each distinct one is computed once."""
    distinct, inverse = np.unique(x, return_inverse=True)
    return np.array([math.lgamma(v) for v in distinct])[inverse].reshape(x.shape)


def beta_inc(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Regularised incomplete beta function, by Lentz's continued fraction."""
    a, b, x = np.broadcast_arrays(*(np.asarray(v, dtype=float) for v in (a, b, x)))
    swap = x > (a + 1) / (a + b + 2)
    p, q = np.where(swap, b, a), np.where(swap, a, b)
    u = np.clip(np.where(swap, 1 - x, x), 0.0, 1.0)
    tiny = 1e-300
    c = np.ones_like(u)
    d = 1 - (p + q) * u / (p + 1)
    d = 1 / np.where(np.abs(d) < tiny, tiny, d)
    h = d.copy()
    for m in range(1, 500):
        for step in (
            m * (q - m) * u / ((p + 2 * m - 1) * (p + 2 * m)),
            -(p + m) * (p + q + m) * u / ((p + 2 * m) * (p + 2 * m + 1)),
        ):
            d = 1 + step * d
            d = 1 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1 + step / c
            c = np.where(np.abs(c) < tiny, tiny, c)
            delta = c * d
            h = h * delta
        if np.all(~np.isfinite(delta) | (np.abs(delta - 1) < 1e-15)):
            break
    with np.errstate(divide="ignore"):
        front = np.exp(
            _lgamma(p + q) - _lgamma(p) - _lgamma(q) + p * np.log(u) + q * np.log1p(-u)
        )
    part = np.where(u <= 0, 0.0, front * h / p)
    return np.where(swap, 1 - part, part)


def student_t_cdf_array(x: np.ndarray, df: np.ndarray) -> np.ndarray:
    x, df = np.broadcast_arrays(np.asarray(x, dtype=float), np.asarray(df, dtype=float))
    half_tail = 0.5 * beta_inc(df / 2, 0.5, df / (df + x * x))
    return np.where(x >= 0, 1 - half_tail, half_tail)


def student_t_sf_array(x: np.ndarray, df: np.ndarray) -> np.ndarray:
    return student_t_cdf_array(-np.asarray(x, dtype=float), df)


def _student_t_starts(tail: np.ndarray, df: np.ndarray, log_front: np.ndarray) -> list[np.ndarray]:
    """Two closed forms for the upper quantile: the power law of the tail, and the normal one with its first correction."""
    # sf(x) is about front * df**((df - 1) / 2) * x**-df far out
    power = (log_front + (df - 1) / 2 * np.log(df) - np.log(tail)) / df
    t = np.sqrt(-2 * np.log(tail))
    z = t - (2.515517 + t * (0.802853 + t * 0.010328)) / (1 + t * (1.432788 + t * (0.189269 + t * 0.001308)))
    z = np.maximum(z, 0.0)
    near = np.arcsinh(z + (z**3 + z) / (4 * df))
    far = np.where(power > 20, power + math.log(2), np.arcsinh(np.exp(np.minimum(power, 20))))
    return [np.clip(near, 0.0, 40.0), np.clip(far, 0.0, 40.0)]


def student_t_ppf_array(p: np.ndarray, df: np.ndarray) -> np.ndarray:
    """Quantiles by Newton's method on the logarithm of the upper tail, to double precision.

    The search runs in y with x = sinh(y), where that logarithm is close to linear for heavy tails, from the
    better of two closed forms; a step that leaves the bracket so far is replaced by halving it.
    Quantiles beyond sinh(40) are given as that. Infinite for p of 0 and 1, NaN outside.
    """
    p, df = np.broadcast_arrays(np.asarray(p, dtype=float), np.asarray(df, dtype=float))
    shape = p.shape
    p, df = p.ravel(), df.ravel()
    tail = np.minimum(p, 1 - p)
    out = np.where(tail == 0, np.inf, np.nan)
    at = np.flatnonzero((tail > 0) & (df > 0))
    goal, v = tail[at], df[at]
    log_front = _lgamma((v + 1) / 2) - _lgamma(v / 2) - 0.5 * np.log(v * math.pi)

    def gap(y: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """ln sf(sinh y) - ln tail, which falls in y, and its slope."""
        x, nu = np.sinh(y), v[rows]
        sf = np.maximum(student_t_sf_array(x, nu), 1e-300)
        density = np.exp(log_front[rows] - (nu + 1) / 2 * np.log1p(x * x / nu))
        return np.log(sf / goal[rows]), -density * np.cosh(y) / sf

    live = np.arange(len(at))
    near, far = _student_t_starts(goal, v, log_front)
    closer = np.abs(gap(near, live)[0]) <= np.abs(gap(far, live)[0]) if len(live) else np.zeros(0, bool)
    y = np.where(closer, near, far)
    low, high = np.zeros_like(y), np.full_like(y, 40.0)
    for _ in range(80):
        if not len(live):
            break
        error, slope = gap(y[live], live)
        low[live] = np.where(error > 0, y[live], low[live])
        high[live] = np.where(error > 0, high[live], y[live])
        new = y[live] - error / np.minimum(slope, -1e-300)
        inside = (new >= low[live]) & (new <= high[live])
        new = np.where(inside, new, (low[live] + high[live]) / 2)
        moved = np.abs(new - y[live])
        y[live] = new
        live = live[moved > 2e-15 * np.maximum(1.0, np.abs(new)) * 2]
    out[at] = np.sinh(y)
    return np.where(p < 0.5, -out, np.where(p > 0.5, out, np.where(tail == 0.5, 0.0, out))).reshape(shape)


def gamma_q(a: float, x: float) -> float:
    """Regularised upper incomplete gamma function."""
    if not (a > 0 and x >= 0):
        return math.nan
    if x == 0:
        return 1.0
    front = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:
        term = total = 1 / a
        k = a
        while abs(term) > abs(total) * 1e-17:
            k += 1
            term *= x / k
            total += term
        return 1 - front * total
    tiny = 1e-300
    b = x + 1 - a
    c, d = 1 / tiny, 1 / b
    h = d
    for i in range(1, 10_000):
        step = -i * (i - a)
        b += 2
        d = step * d + b
        d = 1 / (d if abs(d) > tiny else tiny)
        c = b + step / c
        c = c if abs(c) > tiny else tiny
        h *= c * d
        if abs(c * d - 1) < 1e-16:
            break
    return front * h


#: From this d * d * n on both one-sided events practically never meet.
ONE_SIDED_FROM = 6.0
POISSON_TERMS = 24


def kolmogorov_sf_exact(d: float, n: int) -> float:
    """P(D_n >= d) of the two-sided statistic, without an approximation in d or n.

    Below d * d * n = 6: one minus ``_band_probability``. Rounding there is below 1e-12 for samples up to
    10,000, which is small beside probabilities above 1e-5. From 6 on: twice the one-sided probability, a finite sum of positive
    terms. By inclusion and exclusion that is too large by P(D+ >= d and D- >= d); the limit law puts its share at
    exp(-6 * d * d * n), below 3e-16 there.
    """
    if d <= 0:
        return 1.0
    if d >= 1:
        return 0.0
    if d * d * n >= ONE_SIDED_FROM:
        return min(1.0, 2 * _one_sided(d, n))
    return min(1.0, max(0.0, 1 - _band_probability(d, n)))


def _one_sided(d: float, n: int) -> float:
    """P(D+ >= d) by the sum of Birnbaum and Tingey, its terms taken as logarithms."""
    j = np.arange(int(n * (1 - d)) + 1)
    j = j[1 - d - j / n > 0]
    choose = math.lgamma(n + 1) - _lgamma(j + 1.0) - _lgamma(n - j + 1.0)
    return float(d * np.exp(choose + (j - 1) * np.log(d + j / n) + (n - j) * np.log1p(-(d + j / n))).sum())


def _band_probability(d: float, n: int) -> float:
    """P(D_n < d): the ordered sample as a Poisson path that stays between two lines.

    Time runs in units of 1 / n. The count of values up to a time must be below i at i - n * d and above i at
    i + n * d, for whole i; it is followed from one such time to the next, with the Poisson weights of
    the gap between them, and what left the band is dropped. At the end the count is n, and
    dividing by the probability of that gives the sample's law.
    """
    c = n * d
    upper = [(i - c, 0, i - 1) for i in range(math.floor(c) + 1, n + 1) if i - c > 0]
    lower = [(i + c, i + 1, n) for i in range(n + 1) if i + c < n]
    k = np.arange(POISSON_TERMS)
    factorials = np.exp(_lgamma(k + 1.0))
    mass, first, now = np.ones(1), 0, 0.0
    for time, low, high in sorted(upper + lower) + [(float(n), n, n)]:
        gap = time - now
        mass = np.convolve(mass, np.exp(-gap) * gap**k / factorials)
        low, high = max(low, first), min(high, first + len(mass) - 1)
        if low > high:
            return 0.0
        mass, first, now = mass[low - first : high - first + 1], low, time
    return float(mass[-1]) * math.exp(n - n * math.log(n) + math.lgamma(n + 1))


# --- pandas UDFs over the helpers -----------------------------------------


@F.pandas_udf(DoubleType())
def student_t_cdf(x: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series(student_t_cdf_array(x.to_numpy(float), df.to_numpy(float)))


@F.pandas_udf(DoubleType())
def student_t_ppf(p: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series(student_t_ppf_array(p.to_numpy(float), df.to_numpy(float)))


@F.pandas_udf(DoubleType())
def student_t_two_sided(t: pd.Series, df: pd.Series) -> pd.Series:
    """Two-sided p-value of a t statistic."""
    return pd.Series(2 * student_t_sf_array(np.abs(t.to_numpy(float)), df.to_numpy(float)))


@F.pandas_udf(DoubleType())
def f_sf(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    """Upper tail of the F distribution."""
    a, b, x = d2.to_numpy(float), d1.to_numpy(float), f.to_numpy(float)
    return pd.Series(beta_inc(a / 2, b / 2, a / (a + b * x)))


@F.pandas_udf(DoubleType())
def chi2_sf(x: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([gamma_q(k / 2, v / 2) for v, k in zip(x, df)], dtype=float)


@F.pandas_udf(DoubleType())
def kolmogorov_sf(d: pd.Series, n: pd.Series) -> pd.Series:
    """p-value of the two-sided one-sample Kolmogorov–Smirnov statistic."""
    return pd.Series(
        [math.nan if math.isnan(v) else kolmogorov_sf_exact(v, int(k)) for v, k in zip(d, n)],
        dtype=float,
    )


@F.pandas_udf(DoubleType())
def student_t_log_norm(df: pd.Series, scale: pd.Series) -> pd.Series:
    """Logarithm of the constant in front of the Student-t density."""
    v = df.to_numpy(float)
    return pd.Series(
        _lgamma((v + 1) / 2)
        - _lgamma(v / 2)
        - 0.5 * np.log(v * math.pi)
        - np.log(scale.to_numpy(float))
    )
