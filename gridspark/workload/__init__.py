"""Every operator as a query over the test tables, with the same result in plain SQL where it has one."""

from gridspark.workload import domain, forecasting, geography, networks, quality, relational, statistics  # noqa: F401
from gridspark.workload.base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
