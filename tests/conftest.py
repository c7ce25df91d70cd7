import os
import random
import sys

import pytest

sys.path[:0] = [os.path.join(os.path.dirname(__file__), ".."), os.path.dirname(__file__)]

from ebbtide.session import build_session  # noqa: E402
from ebbtide.sources.schema import CANONICAL, CUSTOMER_SCHEMA  # noqa: E402
from rows import customer  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", **{
        "spark.master": "local[8]", "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make(spark):
    def frame(rows):
        return spark.createDataFrame([tuple(r[c] for c in CANONICAL) for r in rows], CUSTOMER_SCHEMA)
    return frame


@pytest.fixture(scope="session")
def sample(make):
    def frame(n=100, seed=42, **overrides):
        rng = random.Random(seed)
        return make([customer(i, rng, **overrides) for i in range(n)])
    return frame
