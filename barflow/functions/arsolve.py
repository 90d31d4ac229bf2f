"""Autoregressions of every order from one row of centred sums per symbol, a batch of symbols at a time.

The centred sums of products C of the lags are factored order by order, C = U' D U with a unit upper
triangle U. With V the inverse of U, order p has

    coefficient_i = sum over k = i..p of V[i, k] * g[k],     g[k] = (what y keeps of lag k) / d[k],
    rss           = C[y, y] - sum over k <= p of d[k] * g[k]**2,
    inverse[i, j] = sum over k <= p of V[i, k] * V[j, k] / d[k],

so one factorisation serves all orders. Lags are scaled to unit length first, and the first pivot that
is not above ``PIVOT`` of its lag ends the orders of a symbol: that lag repeats the ones before it.

Shipped to the workers by value, like ``numerics``.
"""

from __future__ import annotations

import math
import sys
from dataclasses import dataclass

import numpy as np
from pyspark import cloudpickle

from barflow.functions.numerics import student_t_sf_array

cloudpickle.register_pickle_by_value(sys.modules[__name__])

Z_95 = 1.959963984540054
PIVOT = 1e-11
LOG_TWO_PI_E = math.log(2 * math.pi) + 1


@dataclass(frozen=True)
class Autoregressions:
    """The chosen order of each symbol, with its coefficients (0 beyond the order), variance and AIC."""

    order: np.ndarray
    constant: np.ndarray
    slopes: np.ndarray  # symbols x lags
    sigma2: np.ndarray
    aic: np.ndarray
    errors: np.ndarray  # standard errors of constant and slopes
    n: np.ndarray


def factor(cross: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pivots d, rows V, loads g and how many lags are usable, for stacked C with y last."""
    m, size, _ = cross.shape
    lags = size - 1
    left = cross.copy()
    d, g = np.zeros((m, lags)), np.zeros((m, lags))
    upper = np.tile(np.eye(lags), (m, 1, 1))
    usable, alive = np.zeros(m, dtype=int), np.ones(m, dtype=bool)
    for k in range(lags):
        pivot = left[:, k, k]
        alive = alive & (pivot > PIVOT * cross[:, k, k]) & (cross[:, k, k] > 0)
        usable += alive
        d[:, k] = np.where(alive, pivot, 1.0)
        row = np.where(alive[:, None], left[:, k, :] / d[:, k, None], 0.0)
        upper[:, k, k + 1 :] = row[:, k + 1 : lags]
        g[:, k] = row[:, lags]
        left[:, k + 1 :, k + 1 :] -= d[:, k, None, None] * row[:, k + 1 :, None] * row[:, None, k + 1 :]
    return d, np.linalg.inv(upper), g, usable


def best_orders(n: np.ndarray, means: np.ndarray, cross: np.ndarray) -> Autoregressions:
    """Least squares of the last column on the lags, of the order with the smallest AIC for each symbol.

    ``cross`` has the centred sums of products, lags first. All orders are compared on the same
    rows; AIC is that of the full normal likelihood, with order + 1 parameters.
    """
    m, size, _ = cross.shape
    lags = size - 1
    scale = np.sqrt(np.einsum("mii->mi", cross))
    scale = np.where(scale > 0, scale, 1.0)
    d, v, g, usable = factor(cross / (scale[:, :, None] * scale[:, None, :]))
    p = np.arange(lags + 1)
    explained = np.concatenate([np.zeros((m, 1)), np.cumsum(d * g**2, axis=1)], axis=1)
    one = np.einsum("mii->mi", cross)[:, -1] / scale[:, -1] ** 2  # 1, or 0 for a constant series
    rss = np.maximum(one[:, None] - explained, 0.0) * scale[:, -1:] ** 2
    aic = n[:, None] * (LOG_TWO_PI_E + np.log(np.maximum(rss, 1e-300) / n[:, None])) + 2 * (p + 1)
    allowed = (p <= usable[:, None]) & (n[:, None] - p - 1 >= 1)
    order = np.argmin(np.where(allowed, aic, np.inf), axis=1)
    at = np.arange(m)
    inside = (p[1:] <= order[:, None]).astype(float)  # lag k takes part
    slopes = np.einsum("mik,mk->mi", v, g * inside) * scale[:, -1:] / scale[:, :lags]
    centre = means[:, :lags] / scale[:, :lags]
    spread = np.concatenate(
        [
            (1 / n + ((np.einsum("mi,mik->mk", centre, v) ** 2) * inside / d).sum(axis=1))[:, None],
            np.einsum("mik,mk->mi", v**2, inside / d) / scale[:, :lags] ** 2,
        ],
        axis=1,
    )
    sigma2 = rss[at, order] / (n - order - 1)
    constant = means[:, -1] - (slopes * means[:, :lags]).sum(axis=1)
    return Autoregressions(order, constant, slopes, sigma2, aic[at, order], np.sqrt(sigma2[:, None] * spread), n)


def forecast_steps(fit: Autoregressions, recent: np.ndarray, horizon: int) -> tuple[np.ndarray, np.ndarray]:
    """Point forecasts and half widths of their 95 % limits, symbols x steps; ``recent`` is newest first."""
    m, lags = fit.slopes.shape
    values, weights = recent.astype(float).copy(), np.zeros((m, lags))
    means, halves, spread, weight = np.zeros((m, horizon)), np.zeros((m, horizon)), np.zeros(m), np.ones(m)
    for step in range(horizon):
        means[:, step] = fit.constant + (fit.slopes * values).sum(axis=1)
        spread += weight**2
        halves[:, step] = Z_95 * np.sqrt(fit.sigma2 * spread)
        values = np.column_stack([means[:, step], values[:, : lags - 1]])
        weights = np.column_stack([weight, weights[:, : lags - 1]])
        weight = (fit.slopes * weights).sum(axis=1)
    return means, halves


def p_values(fit: Autoregressions) -> np.ndarray:
    """Two-sided, of constant and slopes; NaN where there is no standard error."""
    estimates = np.column_stack([fit.constant, fit.slopes])
    dof = np.broadcast_to((fit.n - fit.order - 1)[:, None].astype(float), estimates.shape)
    known = fit.errors > 0
    t = np.abs(estimates) / np.where(known, fit.errors, 1.0)
    found = 2 * student_t_sf_array(t.ravel(), dof.ravel()).reshape(t.shape)
    return np.where(known, found, np.nan)
