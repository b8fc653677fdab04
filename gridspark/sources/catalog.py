"""A catalog of named tables: resolve, read, list, and compare with what is published."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.operators.query import query
from gridspark.sources.registry import GROUP_VIEWS, GROUPS

Source = str | DataFrame | Callable[[], DataFrame]


class Catalog:
    """Names to tables.

    A table is read, in this order, from what was registered for it (a frame, a function giving one, or
    a path), from ``<root>/<dataset id>`` as Parquet, or as a table of the session's own catalog.
    ``ids`` replaces dataset ids, e.g. by those of a publisher.
    """

    def __init__(self, spark: SparkSession, root: str | None = None, ids: Mapping[str, str] | None = None, groups=None):
        self.spark = spark
        self.root = root
        self._groups = groups or GROUPS
        self._sources: dict[str, Source] = {}
        self._names: dict[str, dict[str, str]] = {}
        for group, tables in self._groups.items():
            names = self._names.setdefault(group, {})
            for main, others in tables.items():
                dataset = (ids or {}).get(main, f"{group}/{main}")
                names.update({n: dataset for n in (main, *others)})
        if groups is None:
            known = self.names()
            for group, members in GROUP_VIEWS.items():
                self._names[group] = {n: known[n] for n in members}

    def names(self, group: str | None = None) -> dict[str, str]:
        """Name to dataset id, for one group or for all."""
        if group is not None:
            return self._names[group]
        return {n: d for names in self._names.values() for n, d in names.items()}

    def resolve(self, name: str, group: str | None = None) -> str:
        """Dataset id of a name (or of an id itself); an unknown name raises ``ValueError``."""
        names = self.names(group)
        if name in names.values():
            return name
        if name not in names:
            raise ValueError(f"no table is named {name!r}; names are {', '.join(names)}")
        return names[name]

    def register(self, name: str, source: Source, group: str | None = None) -> None:
        self._sources[self.resolve(name, group)] = source

    def read(self, name: str, group: str | None = None) -> DataFrame:
        dataset = self.resolve(name, group)
        source = self._sources.get(dataset)
        if source is None and self.root:
            source = f"{self.root}/{dataset}"
        if source is None:
            return self.spark.read.table(dataset.replace("/", "."))
        if isinstance(source, DataFrame):
            return source
        return self.spark.read.parquet(source) if isinstance(source, str) else source()

    def get(self, name: str, limit: int | None = None, group: str | None = None, **params) -> DataFrame:
        """Rows of a named table under the query parameters of :func:`gridspark.operators.query.query`."""
        return query(self.read(name, group), limit=limit, **params)

    def entries(self) -> DataFrame:
        """The catalog as a frame: one row per group and name."""
        rows = [(g, n, d) for g, names in self._names.items() for n, d in names.items()]
        return self.spark.createDataFrame(rows, "group_name string, alias string, dataset_id string")

    def list_datasets(self, limit: int | None = None, offset: int = 0, **params) -> DataFrame:
        """Filter, sort and page over the catalog."""
        params.setdefault("order_by", "group_name, alias")
        return query(self.entries(), limit=limit, offset=offset, **params)


def schema_drift(stored: DataFrame, live: DataFrame) -> DataFrame:
    """Columns added and removed per dataset that is in both snapshots; unchanged ones are left out.

    Both frames are ``(dataset_id, fields array<string>)``.
    """
    both = stored.select("dataset_id", F.col("fields").alias("_s")).join(
        live.select("dataset_id", F.col("fields").alias("_l")), "dataset_id"
    )
    changes = both.select(
        "dataset_id",
        F.sort_array(F.array_except("_l", "_s")).alias("added"),
        F.sort_array(F.array_except("_s", "_l")).alias("removed"),
    )
    changed = changes.where((F.size("added") > 0) | (F.size("removed") > 0))
    return changed.withColumn("breaking", F.size("removed") > 0)


def published_ids(metadata: DataFrame, dataset_id: str = "datasetid", title: str = "`default.title`") -> DataFrame:
    """``(dataset_id, title)`` of a metadata table: blank ids are skipped, the first title wins.

    First is by the ``row`` column when there is one, else the smallest title.
    """
    order = F.col("row") if "row" in metadata.columns else F.trim(F.coalesce(F.col(title), F.lit("")))
    rows = metadata.select(F.trim(dataset_id).alias("dataset_id"), F.trim(F.coalesce(F.col(title), F.lit(""))).alias("title"), order.alias("_o"))
    return rows.where(F.col("dataset_id") != "").groupBy("dataset_id").agg(F.min_by("title", "_o").alias("title"))


def unmanaged_ids(published: DataFrame, known: DataFrame) -> DataFrame:
    """Published datasets that no name points to."""
    return published.join(known.select("dataset_id").distinct(), "dataset_id", "left_anti")


def merged_ids(left: DataFrame, right: DataFrame) -> DataFrame:
    """Sorted union of two id lists."""
    return left.select("dataset_id").union(right.select("dataset_id")).distinct().orderBy("dataset_id")
