import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from barflow.llm import topk
from barflow.llm.queries import ORACLES, QUERIES


def third():
    return F.col("vec_id") % 3 == 0


def whole(vector):
    return [int(np.floor(1024 * float(np.float32(x)))) for x in vector]


def usable(vector):
    return vector is not None and all(x is not None and np.isfinite(x) for x in vector)


def plain(rows, k, step):
    """All scores of every query, ranked."""
    kept = [(i, whole(v)) for i, v in rows if usable(v)]
    out = []
    for a, (query, q) in enumerate(kept):
        if query is None or query % step:
            continue
        scores = [(-sum(x * y for x, y in zip(q, v, strict=False)), i is None, i or 0) for b, (i, v) in enumerate(kept) if b != a]
        out += [(query, n, None if null else i, -s) for n, (s, null, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def found(df, *args, **options):
    return sorted((tuple(r) for r in topk.nearest(df, *args, **options).collect()), key=str)


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(0, 1 + i % 4, 7)]) for i in range(150)]
    rows += [(i, [0.5] * 7) for i in range(150, 190)]  # many ties
    rows += [(7, rows[7][1]), (9, [1.0] * 7), (None, [2.0] * 7), (3, None), (6, [1.0, None]), (12, [float("nan")] * 7), (15, [float("inf")]), (18, []), (21, [3.0, -1.0])]
    return rows


@pytest.mark.parametrize("lists", [1, 2, 3, 9])
def test_small_tables_equal_all_scores(spark, vectors, lists, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 16)
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").repartition(3)
    assert found(df, third(), k=5, lists=lists) == plain(vectors, 5, 3)


def test_few_candidates_and_none(spark, vectors):
    shape = "vec_id long, embedding array<float>, score long, rank string, query_id int"
    rows = [(*r, 1, "x", 2) for r in vectors[:4]]
    assert found(spark.createDataFrame(rows, shape), third()) == plain(vectors[:4], 10, 3)
    assert found(spark.createDataFrame(rows[:1], shape), third()) == []
    assert found(spark.createDataFrame([], shape), third()) == []
    assert found(spark.createDataFrame([(3, None)], "vec_id long, embedding array<float>"), third()) == []


def test_numbers_beyond_doubles(spark):
    rows = [(3, [1e12, 1.0]), (1, [1e12, 3.0]), (2, [1e12, 2.0]), (4, [-1e12, 5.0]), (5, [1e30, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = found(df, third(), k=4)
    exact = lambda v: [max(min(int(np.floor(1024 * x)), 2**61), -(2**61)) for x in v]
    q = exact(rows[0][1])
    scores = {i: max(min(sum(a * b for a, b in zip(q, exact(v), strict=True)), 2**63 - 1), -(2**63)) for i, v in rows[1:]}
    order = sorted(scores, key=lambda i: (-scores[i], i))
    assert got == sorted(((3, n, i, scores[i]) for n, i in enumerate(order, 1)), key=str)


def test_cutoff_is_safe_and_spares_rows():
    rng = np.random.default_rng(4)
    numbers = rng.integers(-300, 300, (600, 64))
    side = topk.Side.__new__(topk.Side)
    side.numbers, side.uids, side.ids = numbers, np.arange(600), np.arange(600)
    queries = topk.Side.__new__(topk.Side)
    queries.numbers, queries.uids, queries.ids = numbers[:20], np.arange(20), np.arange(20)
    at, score = topk.gather(queries, side, 10, 2)
    assert np.bincount(at).max() <= 20
    queries.cutoffs = np.array([np.sort(score[at == q])[-10] for q in range(20)])
    queries.known = np.ones(20, dtype=bool)
    at, column, score = topk.resolve(queries, side, 2)
    exact = numbers[:20] @ numbers.T
    np.fill_diagonal(exact, -(2**60))
    want = {(q, c) for q, c in zip(*np.nonzero(exact >= queries.cutoffs[:, None]), strict=True)}
    assert set(zip(at, column, strict=True)) == want and len(want) < 20 * 600 / 10
    assert (exact[at, column] == score).all()


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{brute.SF}/embeddings.parquet'")
    got = sorted(tuple(r) for r in QUERIES["op12_exact_top_k"](spark, brute.SF).select("query_id", "rank", "vec_id", "score").collect())
    assert got == sorted(con.execute(ORACLES["op12_exact_top_k"]).fetchall()) and got
