import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tiffinlake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g"})
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def base(spark):
    from tiffinlake.session import scratch

    return scratch(spark, "test")


T0 = dt.datetime(2024, 3, 1)


def at(seconds=0, micros=0):
    return T0 + dt.timedelta(seconds=seconds, microseconds=micros)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
