import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

from barflow.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "barflow-tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__driver__memory="4g",
        spark__python__sql__dataFrameDebugging__enabled="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def series(spark):
    """Two daily return series with known values, as a frame and as arrays."""
    import datetime as dt

    import numpy as np

    rng = np.random.default_rng(5)
    values = {"A": rng.standard_t(4, 400) * 0.02 + 0.001, "B": rng.normal(0, 0.03, 300)}
    start = dt.date(2020, 1, 1)
    rows = [
        (symbol, start + dt.timedelta(days=i), float(v))
        for symbol, array in values.items()
        for i, v in enumerate(array)
    ]
    return spark.createDataFrame(rows, "symbol string, ds date, ret double"), values


def rows_by(df, key):
    return {row[key]: row for row in df.collect()}
