"""Fitters that follow a series value by value, for walk-forward forecasts in one ordered pass.

An incremental fitter has three methods. ``start()`` gives the state of an empty series,
``update(state, value)`` the state after the next value, and ``forecast(state)`` the value expected
next, or None where there is none yet. A state belongs to one series; it may be changed in place.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any, Protocol

import pandas as pd
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class IncrementalFitter(Protocol):
    def start(self) -> Any: ...

    def update(self, state: Any, value: float) -> Any: ...

    def forecast(self, state: Any) -> float | None: ...


def is_incremental(fitter: object) -> bool:
    return all(callable(getattr(fitter, name, None)) for name in ("start", "update", "forecast"))


@dataclass
class LeastSquaresState:
    recent: list[float] = field(default_factory=list)  # newest first
    rows: int = 0
    triangle: list[list[float]] = field(default_factory=list)


@dataclass(frozen=True)
class RecursiveLeastSquares:
    """Autoregression of ``order`` lags with a constant, refitted with every value.

    The state is the triangular factor of the design with the value as last column. A new row is
    rotated into it (Givens), which is exact least squares without a starting guess and never forms the
    sums of squares, so series far from zero do not cancel. ``forgetting`` below 1 weighs a row by
    that factor for every later one.
    """

    order: int = 1
    forgetting: float = 1.0
    tolerance: float = 1e-12

    def start(self) -> LeastSquaresState:
        size = self.order + 2
        return LeastSquaresState(triangle=[[0.0] * size for _ in range(size)])

    def update(self, state: LeastSquaresState, value: float) -> LeastSquaresState:
        if len(state.recent) == self.order:
            self._rotate(state.triangle, [1.0, *state.recent, value])
            state.rows += 1
        state.recent = [value, *state.recent][: self.order]
        return state

    def _rotate(self, triangle: list[list[float]], row: list[float]) -> None:
        fade = math.sqrt(self.forgetting)
        for i, line in enumerate(triangle):
            if fade != 1.0:
                line[:] = [fade * x for x in line]
            length = math.hypot(line[i], row[i])
            if length == 0.0:
                continue
            c, s = line[i] / length, row[i] / length
            for j in range(i, len(row)):
                line[j], row[j] = c * line[j] + s * row[j], c * row[j] - s * line[j]

    def forecast(self, state: LeastSquaresState) -> float | None:
        used = self.order + 1
        if state.rows < used:
            return None
        beta = [0.0] * used
        for i in range(used - 1, -1, -1):
            line = state.triangle[i]
            # a lag that does not vary beside the others leaves nothing on the diagonal
            size = math.sqrt(math.fsum(state.triangle[k][i] ** 2 for k in range(i + 1)))
            if abs(line[i]) <= self.tolerance * size:
                return None
            beta[i] = (line[used] - math.fsum(line[j] * beta[j] for j in range(i + 1, used))) / line[i]
        return beta[0] + math.fsum(b * x for b, x in zip(beta[1:], state.recent, strict=True))


@dataclass(frozen=True)
class HistoryFitter:
    """A function of the whole daily series so far; its state is that series, which the calendar bounds."""

    fitter: Callable[[pd.Series], float | None]

    def start(self) -> list[float]:
        return []

    def update(self, state: list[float], value: float) -> list[float]:
        state.append(value)
        return state

    def forecast(self, state: list[float]) -> float | None:
        return self.fitter(pd.Series(state))
