"""Every query with SQL gives the same rows as that SQL on the smallest tables."""

from __future__ import annotations

import os

import pytest
from compare import compare, duck

from gridspark.workload import QUERIES, SQL

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", SQL)
def test_same_rows(spark, con, name):
    # A point read may find nothing in the smallest tables.
    assert compare(QUERIES[name](spark, SF), con, SQL[name]) in (None, "no rows")


def test_every_query_runs_and_most_have_sql():
    assert set(SQL) <= set(QUERIES)
    without = sorted(set(QUERIES) - set(SQL))
    assert without == ["gradient_boosting_bands", "horizon_evaluation", "linear_regression_forecast", "random_forest_importances"]
