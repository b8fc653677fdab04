from __future__ import annotations

import os
import sys
from datetime import datetime, timedelta

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from gridspark import get_session  # noqa: E402

START = datetime(2024, 1, 1)


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make(spark):
    """Series frame from values, half-hourly unless times are given."""

    def build(values, step=timedelta(minutes=30), start=START, times=None):
        times = times or [start + i * step for i in range(len(values))]
        rows = [(t, None if v is None else float(v)) for t, v in zip(times, values)]
        return spark.createDataFrame(rows, "ts timestamp_ntz, value double")

    return build


def values_of(df, column="value", order="ts"):
    return [r[column] for r in df.orderBy(order).collect()]
