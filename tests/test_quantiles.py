import datetime as dt

import numpy as np
import pytest

from barflow.operators.describe import clip_central
from barflow.operators.quantiles import exact_quantiles
from barflow.session import shared_dir

PROBABILITIES = {"low": 0.005, "quarter": 0.25, "half": 0.5, "high": 0.995, "least": 0.0, "most": 1.0}


def quantiles_of(spark, groups, **options):
    rows = [(name, None if v is None else float(v)) for name, values in groups.items() for v in values]
    df = spark.createDataFrame(rows, "symbol string, ret double").repartition(5)
    return {r.symbol: r for r in exact_quantiles(df, ["symbol"], "ret", PROBABILITIES, **options).collect()}


def check(got, groups):
    for name, values in groups.items():
        values = np.array([v for v in values if v is not None and not np.isnan(v)], dtype=float)
        for column, p in PROBABILITIES.items():
            assert np.isclose(getattr(got[name], column), np.quantile(values, p), rtol=1e-12, atol=0), (name, column)


@pytest.mark.parametrize(("buckets", "finish"), [(512, 4096), (64, 8)])
def test_selection_equals_sorting(spark, buckets, finish):
    rng = np.random.default_rng(1)
    groups = {
        "normal": rng.normal(0, 1, 300), "heavy": rng.standard_t(1, 200) ** 3, "ties": rng.integers(0, 4, 150), "one": [7.0],
        "flat": [2.5] * 40, "two": [1.0, 2.0], "far": [1e15 + i for i in range(50)], "nulls": [None, float("nan"), 3.0, 1.0],
    }
    check(quantiles_of(spark, groups, buckets=buckets, finish_rows=finish), groups)


def test_hot_group_infinities_and_null_keys(spark):
    rng = np.random.default_rng(2)
    groups = {"hot": np.round(rng.normal(0, 1, 20_000), 3), "a": rng.normal(0, 1, 10), None: [1.0, 2.0, 4.0]}
    check(quantiles_of(spark, groups, buckets=64, finish_rows=100), groups)
    inf = float("inf")
    got = quantiles_of(spark, {"x": [-inf, -inf, 0.0, 1.0, 2.0, 3.0, inf], "tiny": [0.0, 5e-324, 1e-323]}, buckets=16, finish_rows=1)
    assert (got["x"].least, got["x"].half, got["x"].most) == (-inf, 1.0, inf) and got["tiny"].half == 5e-324


def test_empty_tables_and_bad_probabilities(spark):
    assert quantiles_of(spark, {}) == {} and quantiles_of(spark, {"a": [None]}) == {}
    df = spark.createDataFrame([("a", 1.0)], "symbol string, ret double")
    with pytest.raises(ValueError):
        exact_quantiles(df, ["symbol"], "ret", {"q": 1.5})
    both = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 5.0), ("a", 2, 7.0)], "symbol string, k int, ret double")
    got = {(r.symbol, r.k): r.q for r in exact_quantiles(both, ["symbol", "k"], "ret", {"q": 0.5}).collect()}
    assert got == {("a", 1): 1.0, ("a", 2): 6.0}


def test_passes_leave_only_the_result(spark):
    files = spark._jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
    listing = lambda: {f.getPath().getName() for f in files.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(files)}
    before = listing()
    quantiles_of(spark, {"a": np.arange(500.0)}, buckets=16, finish_rows=40)
    assert [name.split("-")[0] for name in listing() - before] == ["quantiles"]


def test_clipping_keeps_both_limits(spark):
    day = dt.date(2024, 1, 1)
    df = spark.createDataFrame([("A", day, float(i)) for i in range(101)] + [("B", day, 1.0)], "symbol string, ds date, ret double")
    kept = clip_central(df, 0.9)
    assert kept.columns == df.columns
    assert sorted(r.ret for r in kept.where("symbol = 'A'").collect()) == [float(i) for i in range(5, 96)]
    assert kept.where("symbol = 'B'").count() == 1
