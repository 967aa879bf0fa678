import os
import sys

import pandas as pd
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from checks.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", partitions=2, memory="6g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def table(spark):
    return lambda name: spark.read.parquet(f"{SF}/{name}.parquet")


@pytest.fixture
def frame(spark):
    """Rows under a DDL schema."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)


@pytest.fixture
def ties(frame):
    values = [1.0, 2.0, 2.0, 3.0, 10.0, 7.0, 7.0, 4.5, None]
    return frame([(v,) for v in values], "s double")


@pytest.fixture
def pairs(frame):
    rows = [(1.0, 2.0), (2.0, 1.0), (2.0, 1.0), (4.0, 5.0), (None, 9.0), (6.0, None)]
    return frame(rows, "x double, y double")


@pytest.fixture(scope="session")
def messy():
    """Ties, gaps, a hot value on more than a third of the rows and a constant."""
    import numpy as np

    rng = np.random.default_rng(11)
    n = 2500
    a = rng.integers(0, 40, n).astype(float)
    b = rng.normal(size=n).round(2)
    c = np.where(rng.random(n) < 0.4, 0.0, (a / 10 + b).round(1))
    frame = pd.DataFrame({"a": a, "b": b, "c": c, "k": 5.0})
    frame.loc[::7, "b"] = None
    frame.loc[::11, "a"] = None
    return frame
