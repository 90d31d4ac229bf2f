"""PCA whitening of embeddings: covariance by Spark, leading eigenvectors of it by Householder and Sturm.

1. One pass adds up n and the exact sums S of the integer vectors; a second one adds up the products
   of the vectors centred on S / n, block by block. What tasks send is one line per dimension.
2. The covariance, d x d whatever the number of rows, is brought to tridiagonal form by Householder
   reflections. Sturm counts (how many pivots of T - x are negative, hence how many eigenvalues lie
   below x) bisect for the leading eigenvalues. Inverse iteration with the factored T - e gives the
   components; those whose eigenvalues lie close together are orthogonalised against each other in
   every step, and all are turned back by the reflections.
3. Mean and components, d x 8 numbers, are sent to all tasks, which project their rows.

The whitened values are centred by construction, S being exact; a last pass adds up their products and the rest of
their mean, to say how far their covariance is from the identity.

Defined results: vectors that are null or hold a null or non-finite component take no part; shorter
ones count as ending in zeros; components whose eigenvalue is not above 1e-12 of the trace cannot be
whitened and have no row, so vectors that are all equal, and an empty table, give none; with fewer
than eight dimensions there are as many components as dimensions at most; repeated rows count and
are returned one by one; a deviation beyond 38 digits is null; further columns are dropped.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.llm import vectors

cloudpickle.register_pickle_by_value(sys.modules[__name__])

OFFSET = 100_000
RANK_SHARE = 1e-12
#: Eigenvalues closer than this share of the matrix norm form a cluster.
CLUSTER_SHARE = 1e-3


# ---- leading eigenpairs of a symmetric matrix


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and Householder vectors u, with (1 - 2 u u') ... applied on both sides."""
    a = np.array(a, dtype=np.float64)
    n = len(a)
    reflections = []
    for k in range(n - 2):
        x = a[k + 1 :, k]
        u = x.copy()
        u[0] += np.copysign(np.linalg.norm(x), x[0])
        length = np.linalg.norm(u)
        u = u / length if length > 0 else np.zeros_like(u)
        reflections.append(u)
        block = a[k + 1 :, k + 1 :]
        p = block @ u
        w = p - (u @ p) * u
        block -= 2 * (np.outer(u, w) + np.outer(w, u))
        a[k + 1 :, k] -= 2 * (u @ x) * u
    return np.diag(a).copy(), np.array([a[i + 1, i] for i in range(n - 1)]), reflections


def count_below(diagonal: np.ndarray, squares: np.ndarray, x: np.ndarray, tiny: float) -> np.ndarray:
    """Sturm count: number of eigenvalues below each x; ``squares`` are those of the off-diagonal."""
    pivot = diagonal[0] - x
    below = (pivot < 0).astype(int)
    for d, b in zip(diagonal[1:], squares, strict=True):
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        pivot = d - x - b / pivot
        below += pivot < 0
    return below


def leading_eigenvalues(diagonal: np.ndarray, off: np.ndarray, count: int) -> np.ndarray:
    """The ``count`` largest, falling, each bisected down to neighbouring doubles."""
    n = len(diagonal)
    reach = np.zeros(n)
    reach[:-1] += np.abs(off)
    reach[1:] += np.abs(off)
    low, high = np.min(diagonal - reach), np.max(diagonal + reach)
    margin = max(abs(low), abs(high), np.finfo(float).tiny) * 1e-15
    tiny = np.finfo(float).eps ** 2 * max(abs(low), abs(high), np.finfo(float).tiny)
    rank = n - 1 - np.arange(count)  # the i-th largest has n - 1 - i eigenvalues below it
    lows, highs = np.full(count, low - margin), np.full(count, high + margin)
    for _ in range(200):
        middle = lows + (highs - lows) / 2
        above = count_below(diagonal, off**2, middle, tiny) <= rank
        lows, highs = np.where(above, middle, lows), np.where(above, highs, middle)
        if np.all((middle <= lows) | (middle >= highs)) and np.all(highs - lows <= 4 * np.spacing(np.abs(lows) + np.abs(highs))):
            break
    return lows + (highs - lows) / 2


def solve_shifted(diagonal: np.ndarray, off: np.ndarray, shift: float, right: np.ndarray, tiny: float) -> np.ndarray:
    """(T - shift) x = right by elimination with row interchanges; a vanishing pivot is replaced by ``tiny``."""
    n = len(diagonal)
    u0, u1, u2 = diagonal - shift, np.append(off, 0.0), np.zeros(n)
    low, x = np.append(off, 0.0), right.copy()
    for i in range(n - 1):
        if abs(low[i]) > abs(u0[i]):  # the row below comes first
            first = low[i], u0[i + 1], u1[i + 1]
            second = u0[i], u1[i], u2[i]
            x[i], x[i + 1] = x[i + 1], x[i]
        else:
            first = u0[i] if u0[i] != 0 else tiny, u1[i], u2[i]
            second = low[i], u0[i + 1], u1[i + 1]
        factor = second[0] / first[0]
        u0[i], u1[i], u2[i] = first
        u0[i + 1], u1[i + 1] = second[1] - factor * first[1], second[2] - factor * first[2]
        x[i + 1] -= factor * x[i]
    for i in range(n - 1, -1, -1):
        rest = x[i] - (u1[i] * x[i + 1] if i + 1 < n else 0) - (u2[i] * x[i + 2] if i + 2 < n else 0)
        x[i] = rest / (u0[i] if abs(u0[i]) > tiny else tiny)
        if abs(x[i]) > 1e250:  # only the direction counts
            x *= 1e-250
    return x


def eigenvectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit vectors in columns, by inverse iteration; those of a cluster stay orthogonal in every step."""
    n = len(diagonal)
    norm = max(np.abs(diagonal).max(initial=0) + 2 * np.abs(off).max(initial=0), np.finfo(float).tiny)
    tiny = np.finfo(float).eps * norm
    out = np.zeros((n, len(values)))
    first = 0
    random = np.random.default_rng(n)
    for i, value in enumerate(values):
        if i and values[i - 1] - value > CLUSTER_SHARE * norm:
            first = i
        x = random.standard_normal(n)
        # equal doubles in a cluster are set apart by rounding's breadth, so their factors differ
        shift = value - (i - first) * 2 * np.finfo(float).eps * norm
        for _ in range(6):
            x = solve_shifted(diagonal, off, shift, x / np.linalg.norm(x), tiny)
            x /= np.abs(x).max()
            for _ in range(2):
                x -= out[:, first:i] @ (out[:, first:i].T @ x)
        out[:, i] = x / np.linalg.norm(x)
    return out


def leading_eigenpairs(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Largest eigenvalues, falling, and their unit eigenvectors in columns."""
    count = min(count, len(matrix))
    if not count:
        return np.zeros(0), np.zeros((len(matrix), 0))
    scale = np.abs(matrix).max()
    if scale == 0:
        return np.zeros(count), np.eye(len(matrix), count)
    diagonal, off, reflections = tridiagonal(matrix / scale)
    values = leading_eigenvalues(diagonal, off, count)
    found = eigenvectors(diagonal, off, values)
    for k in range(len(reflections) - 1, -1, -1):
        u = reflections[k]
        found[k + 1 :] -= 2 * np.outer(u, u @ found[k + 1 :])
    found, _ = np.linalg.qr(found)  # rounding only: the columns are orthogonal already
    return values * scale, found


# ---- sums over all rows


def exact_sums(rows: DataFrame, width: int) -> tuple[int, list[int]]:
    """n and the sum of every dimension, as Python integers."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * width
        for batch in batches:
            numbers = vectors.matrix(batch.column(0), width)
            wide = np.abs(numbers).max(initial=0) < 2**40
            part = numbers.sum(axis=0).tolist() if wide else numbers.astype(object).sum(axis=0).tolist()
            n, sums = n + len(numbers), [a + int(b) for a, b in zip(sums, part, strict=True)]
        if n:
            yield pa.RecordBatch.from_pydict({"j": [-1, *range(width)], "total": [str(n), *map(str, sums)]})

    parts = rows.select("components").mapInArrow(add, "j long, total string")
    totals = parts.groupBy("j").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()  # width + 1 lines
    by = {r["j"]: int(r["total"]) for r in totals}
    return by.get(-1, 0), [by.get(j, 0) for j in range(width)]


def product_sums(rows: DataFrame, to_columns, width: int) -> tuple[int, np.ndarray, np.ndarray]:
    """n, mean and mean of x x' for the x that ``to_columns`` makes of a matrix of components."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, products = 0, np.zeros(width), np.zeros((width, width))
        for batch in batches:
            x = to_columns(batch.column(0))
            n += len(x)
            total += x.sum(axis=0)
            products += x.T @ x
        if n:
            lines = np.vstack([total, products])
            lists = pa.ListArray.from_arrays(np.arange(width + 2, dtype=np.int32) * width, pa.array(lines.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, width, dtype=np.int32)), pa.array([n] * (width + 1)), lists], names=["i", "n", "sums"])

    parts = rows.select("components").mapInArrow(add, "i int, n long, sums array<double>")
    one = parts.select("i", "n", F.posexplode("sums").alias("j", "part"))
    # d x d lines at most reach the driver, whatever the number of rows
    lines = one.groupBy("i", "j").agg(F.sum("n").alias("n"), F.sum("part").alias("part")).toPandas()
    sums = np.zeros((width + 1, width))
    sums[lines["i"] + 1, lines["j"]] = lines["part"]
    n = int(lines["n"].max()) if len(lines) else 0
    return n, sums[0] / max(n, 1), sums[1:] / max(n, 1)


@dataclass(frozen=True)
class Fit:
    n: int
    sums: list[int]
    values: np.ndarray  # leading eigenvalues
    components: np.ndarray  # d x k, in columns
    explained: np.ndarray
    identity_error: float

    @property
    def projection(self) -> np.ndarray:
        return self.components / np.sqrt(self.values)


def centred(components: pa.Array, n: int, sums: list[int]) -> np.ndarray:
    """x - S / n, taken from whole numbers where they fit: (n x - S) / n."""
    numbers = vectors.matrix(components, len(sums))
    whole = [s // n for s in sums]
    rest = np.array([(s % n) / n for s in sums])
    return (numbers - np.array(whole, dtype=np.int64)).astype(np.float64) - rest


def fit(rows: DataFrame, count: int = 8) -> Fit:
    """Mean and components of all ``rows`` (vec_id, components)."""
    width = rows.agg(F.max(F.size("components"))).first()[0] or 0
    n, sums = exact_sums(rows, width)
    if not n or not width:
        return Fit(n, sums, np.zeros(0), np.zeros((width, 0)), np.zeros(0), 0.0)
    _, _, covariance = product_sums(rows, lambda c: centred(c, n, sums), width)
    values, components = leading_eigenpairs(covariance, count)
    trace = float(np.trace(covariance))
    used = values > RANK_SHARE * trace
    values, components = values[used], components[:, used]
    plain = Fit(n, sums, values, components, values / trace if trace else values, 0.0)
    if not len(values):
        return plain
    projection = plain.projection
    _, mean, products = product_sums(rows, lambda c: centred(c, n, sums) @ projection, len(values))
    error = float(np.abs(products - np.outer(mean, mean) - np.eye(len(values))).max())
    return Fit(n, sums, values, components, plain.explained, error)


WHITENED = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


def deviations(components: pa.Array, n: int, sums: list[int]) -> list:
    """Sum over the dimensions of (n x - S)**2, exact; None beyond 38 digits."""
    numbers = vectors.matrix(components, len(sums))
    total = np.array(sums, dtype=object)
    largest = max(abs(int(numbers.max(initial=0))), abs(int(numbers.min(initial=0)))) * n + max(map(abs, sums), default=0)
    if len(sums) * largest**2 < 2**63:
        return ((numbers * n - total.astype(np.int64)) ** 2).sum(axis=1).tolist()
    spread = numbers * n - total.astype(np.int64) if largest < 2**62 else numbers.astype(object) * n - total
    if len(sums) * int(np.abs(spread).max(initial=0)) ** 2 < 2**63:
        return (spread**2).sum(axis=1).tolist()
    exact = (spread.astype(object) ** 2).sum(axis=1)
    return [int(x) if x < 10**38 else None for x in exact]


def whitened(rows: DataFrame, model: Fit) -> DataFrame:
    """Every row's values on the components of ``model``."""
    projection, explained, n, sums, error = model.projection, model.explained, model.n, model.sums, model.identity_error
    k = len(explained)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from decimal import Decimal

        for batch in batches:
            if not batch.num_rows or not k:
                continue
            m = batch.num_rows
            values = centred(batch.column(1), n, sums) @ projection
            exact = [None if x is None else Decimal(x) for x in deviations(batch.column(1), n, sums)]
            each = np.repeat(np.arange(m), k)
            columns = [
                batch.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)),
                pa.array(exact, type=pa.decimal128(38, 0)).take(pa.array(each)), pa.array(values.ravel()),
                pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select("vec_id", "components").mapInArrow(project, WHITENED)


def whiten(df: DataFrame, count: int = 8, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Up to ``count`` whitened components of every vector, fitted on all of them."""
    rows = vectors.integer_vectors(df, id_column, vector, OFFSET)
    return whitened(rows, fit(rows, count))
