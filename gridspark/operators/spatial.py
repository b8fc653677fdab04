"""One bounding box over many tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.functions.geo import bounds_ring
from gridspark.operators.query import query
from gridspark.sources.catalog import Catalog
from gridspark.sources.registry import GEO_TABLES
from gridspark.sources.staging import new_path


@dataclass
class BoundsResult:
    """Frames by table name, and messages for tables that could not be read. ``rows`` holds sizes already known."""

    results: dict[str, DataFrame]
    errors: dict[str, str]
    rows: dict[str, int] = field(default_factory=dict)

    def union(self) -> DataFrame:
        """All rows in one frame, with the table name in ``dataset``."""
        tagged = [df.withColumn("dataset", F.lit(name)) for name, df in self.results.items()]
        out = tagged[0]
        for df in tagged[1:]:
            out = out.unionByName(df, allowMissingColumns=True)
        return out

    def status(self) -> DataFrame:
        """``(dataset, rows)`` for every table that was read, zero rows included."""
        parts = [df.agg(F.count("*").alias("rows")).select(F.lit(n).alias("dataset"), "rows") for n, df in self.results.items()]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out


def query_bounds(catalog: Catalog, bounds: Mapping[str, float], datasets: Sequence[str] | None = None, limit: int | None = None, **params) -> BoundsResult:
    """Rows of each table whose geometry meets the bounds; with a ``limit``, that many per table."""
    datasets = list(GEO_TABLES if datasets is None else datasets)
    known = catalog.names()
    unknown = [d for d in datasets if d not in known]
    if unknown:
        raise ValueError(f"no tables are named {unknown}; names are {list(known)}")
    ring = bounds_ring(bounds["north"], bounds["south"], bounds["east"], bounds["west"])
    results, errors = {}, {}
    for name in datasets:
        try:
            results[name] = query(catalog.read(name), polygon=ring, limit=limit, **params)
        except (PySparkException, ValueError) as exc:
            errors[name] = str(exc)
    return BoundsResult(results, errors)


def fetch_bounds(catalog: Catalog, bounds: Mapping[str, float], datasets: Sequence[str] | None = None, limit: int | None = None, store: str | None = None, at_once: int = 4, **params) -> BoundsResult:
    """As :func:`query_bounds`, with every table read to its end by an action of its own.

    A table that fails while it is read (a damaged file, a lost source) becomes an error entry and leaves the others
    alone. Rows found are written under ``store``, one folder per table; without one, under the shared folder. Up to ``at_once`` tables are
    read side by side.
    """
    planned = query_bounds(catalog, bounds, datasets, limit, **params)
    store = store or new_path(catalog.spark, "bounds")

    def fetch(item: tuple[str, DataFrame]) -> tuple[str, DataFrame | None, int, str]:
        name, df = item
        path = f"{store}/{name}"
        try:
            df.write.parquet(path)
            found = catalog.spark.read.schema(df.schema).parquet(path)
            return name, found, found.count(), ""
        except (PySparkException, Py4JError) as exc:
            return name, None, 0, str(exc)

    with ThreadPoolExecutor(max(1, at_once)) as pool:
        done = list(pool.map(fetch, planned.results.items()))
    results = {name: df for name, df, _, _ in done if df is not None}
    errors = {**planned.errors, **{name: error for name, df, _, error in done if df is None}}
    return BoundsResult(results, errors, {name: n for name, df, n, _ in done if df is not None})


def report(found: BoundsResult, spark) -> DataFrame:
    """``(dataset, rows, error)`` of fetched bounds, one row per table asked for; rows is null where the table failed."""
    rows = [(n, found.rows.get(n), None) for n in found.results] + [(n, None, e) for n, e in found.errors.items()]
    return spark.createDataFrame(rows, "dataset string, rows long, error string")
