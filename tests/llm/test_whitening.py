import math

import numpy as np
import pytest

import brute
from barflow.llm import whitening
from barflow.llm.queries import QUERIES


@pytest.mark.parametrize("n", [1, 2, 3, 8, 40])
@pytest.mark.parametrize("kind", ["random", "close", "multiple", "low rank", "graded", "zero"])
def test_leading_eigenpairs(n, kind):
    rng = np.random.default_rng(n)
    a = rng.standard_normal((n, n))
    base, _ = np.linalg.qr(a)
    values = {
        "random": rng.random(n), "close": 1 + 1e-13 * rng.random(n), "multiple": np.repeat([3.0, 1.0], [n // 2, n - n // 2]),
        "low rank": np.append(np.zeros(n - 1), 2.0), "graded": 10.0 ** -np.arange(n), "zero": np.zeros(n),
    }[kind]
    matrix = (base * values) @ base.T
    matrix = (matrix + matrix.T) / 2
    got, vectors = whitening.leading_eigenpairs(matrix, 8)
    want = np.sort(np.linalg.eigvalsh(matrix))[::-1][:8]
    scale = max(np.abs(matrix).max(), 1e-300)
    assert np.abs(got - want).max() <= 1e-14 * n * scale
    assert np.abs(matrix @ vectors - vectors * got).max() <= 2e-14 * n * scale
    assert np.abs(vectors.T @ vectors - np.eye(len(got))).max() <= 1e-13


def test_sturm_counts():
    rng = np.random.default_rng(1)
    d, e = rng.standard_normal(9), rng.standard_normal(8)
    full = np.diag(d) + np.diag(e, 1) + np.diag(e, -1)
    at = np.linspace(-4, 4, 41)
    want = (np.linalg.eigvalsh(full)[:, None] < at).sum(axis=0)
    assert (whitening.count_below(d, e**2, at, 1e-30) == want).all()


def numbers_of(rows):
    kept = [(i, v) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = max((len(v) for _, v in kept), default=0)
    x = np.zeros((len(kept), width), dtype=np.int64)
    for row, (_, v) in enumerate(kept):
        for j, value in enumerate(v):
            x[row, j] = math.floor(1024 * float(np.float32(value))) + 100_000
    return [i for i, _ in kept], x


def check(df, rows, count=8):
    ids, x = numbers_of(rows)
    n, total = len(x), x.sum(axis=0)
    v = np.cov((x - x.mean(axis=0)).T, bias=True)
    values, vectors = np.linalg.eigh(np.atleast_2d(v))
    values, vectors = values[::-1], vectors[:, ::-1]
    rank = min(count, int((values > 1e-12 * np.trace(np.atleast_2d(v))).sum()))
    got = df.toPandas()
    assert len(got) == n * rank and set(got.n) == {n}
    assert got.identity_error.nunique() == 1 and got.identity_error.iloc[0] <= 1e-4
    got = got.sort_values("component", kind="stable")
    exact = {i: sum((n * int(a) - int(s)) ** 2 for a, s in zip(line, total, strict=True)) for i, line in zip(ids, x, strict=True)}
    for c in range(1, rank + 1):
        part = got[got.component == c].set_index("vec_id")
        assert abs(part.explained.iloc[0] / (values[c - 1] / values.sum()) - 1) < 1e-4
        direction = vectors[:, c - 1]
        want = (x - total / n) @ direction / np.sqrt(values[c - 1])
        mine = part.whitened.loc[ids].to_numpy()
        mine = mine * np.sign(mine @ want)
        assert np.abs(mine - want).max() < 1e-6
    assert all(int(d) == exact[i] for i, d in zip(got.vec_id, got.deviation, strict=True))


def test_query_equals_numpy(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{brute.SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = QUERIES["op13_whitening"](spark, brute.SF)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check(got, rows)


def test_fewer_dimensions_nulls_and_short_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(0, [5, 2, 1], 3)]) for i in range(60)]
    rows += [(60, None), (61, [1.0, None]), (62, [float("nan"), 1.0]), (63, [float("-inf")]), (64, [1.5])]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, component int, n int")
    ids, x = numbers_of(rows)
    x[ids.index(64), 1:] = 0  # a short vector ends in zeros
    got = whitening.whiten(df.where("vec_id <> 64"))
    check(got, [r for r in rows if r[0] != 64])
    assert whitening.whiten(df).where("vec_id = 64").count() == 3


def test_tables_without_components(spark):
    shape = "vec_id long, embedding array<double>"
    for rows in ([], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        assert whitening.whiten(spark.createDataFrame(rows, shape)).count() == 0


def test_large_numbers(spark):
    rows = [(i, [1e11 * (i % 5), float(i)]) for i in range(40)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).toPandas()
    x = np.array([[math.floor(1024 * a) + 100_000 for a in v] for _, v in rows], dtype=object)
    exact = ((40 * x - x.sum(axis=0)) ** 2).sum(axis=1)
    assert [int(d) for d in got[got.component == 1].sort_values("vec_id").deviation] == [int(d) for d in exact]
    huge = spark.createDataFrame([(1, [1e300]), (2, [-1e300]), (3, [0.0])], "vec_id long, embedding array<double>")
    assert whitening.whiten(huge).count() == 3
