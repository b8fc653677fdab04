"""Named, parameterised reads.

Each read is a row of a table: which named table it reads and how each argument becomes a condition.
Values travel as literals, so quotes in them are harmless.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark.functions.scalars import (
    day_literal,
    detect_licence_area,
    licence_area_code,
    licence_area_value,
    parse_voltage,
    transformer_type,
)
from gridspark.operators.query import both, merge_where, query
from gridspark.sources.catalog import Catalog

Rule = Callable[[DataFrame, object], Column]


def equals(column: str) -> Rule:
    return lambda df, v: F.col(column) == F.lit(v)


def area(column: str) -> Rule:
    """Licence area by code or full name, in a table that stores the full name."""
    return lambda df, v: F.col(column) == F.lit(licence_area_value(v))


def area_code(column: str) -> Rule:
    """Licence area in a table that stores the code; a full name is an error."""
    return lambda df, v: F.col(column) == F.lit(licence_area_code(v))


def either(*columns: str) -> Rule:
    def rule(df: DataFrame, v: object) -> Column:
        out = F.col(columns[0]) == F.lit(v)
        for c in columns[1:]:
            out = out | (F.col(c) == F.lit(v))
        return out

    return rule


def contains(column: str) -> Rule:
    return lambda df, v: F.col(column).contains(F.lit(v))


def at_least(column: str) -> Rule:
    return lambda df, v: F.col(column) >= F.lit(v)


def from_day(column: str) -> Rule:
    return lambda df, v: F.col(column) >= F.lit(day_literal(v)).cast(df.schema[column].dataType)


def to_day(column: str) -> Rule:
    """Up to a day: at midnight on a time column, so later rows of that day are left out."""
    return lambda df, v: F.col(column) <= F.lit(day_literal(v)).cast(df.schema[column].dataType)


@dataclass(frozen=True)
class Read:
    group: str
    table: str
    rules: dict[str, Rule] = field(default_factory=dict)
    fixed: Callable[[], Column] | None = None
    # Columns whose end bound the caller may extend to the whole day.
    until: str | None = None


def _days(column: str, end_inclusive_day: bool = False) -> dict[str, Rule]:
    whole_day: Rule = lambda df, v: F.to_date(F.col(column)) <= F.lit(day_literal(v))
    return {"start_date": from_day(column), "end_date": whole_day if end_inclusive_day else to_day(column)}


_LTDS_AREA = {"licence_area": area("licencearea")}
_SITE_EVENTS = {"site_id": equals("der_name"), **_days("start_time_local"), "driver": equals("driver")}

READS: dict[str, Read] = {
    "get_table_1": Read("ltds", "table_1", _LTDS_AREA),
    "get_table_2a": Read("ltds", "table_2a", {**_LTDS_AREA, "substation": equals("lv_substation")}),
    "get_table_2b": Read("ltds", "table_2b", {**_LTDS_AREA, "substation": either("lv_substation_1", "lv_substation_2")}),
    "get_table_3a": Read("ltds", "table_3a", {**_LTDS_AREA, "year": equals("year")}),
    "get_table_3b": Read("ltds", "table_3b", _LTDS_AREA),
    "get_table_4a": Read("ltds", "table_4a", _LTDS_AREA),
    "get_table_4b": Read("ltds", "table_4b", _LTDS_AREA),
    "get_table_5": Read(
        "ltds", "table_5", {**_LTDS_AREA, "fuel_type": contains("fuel_type"), "substation": equals("substation")}
    ),
    "get_table_6": Read("ltds", "table_6", {**_LTDS_AREA, "substation": equals("substation")}),
    "get_table_7": Read("ltds", "table_7", _LTDS_AREA),
    "get_table_8": Read("ltds", "table_8", _LTDS_AREA),
    "get_projects": Read(
        "ltds",
        "projects",
        {
            "licence_area": equals("dno"),
            "local_authority": contains("local_authority"),
            "expected_start_year": equals("expected_start_year"),
        },
    ),
    "get_headroom": Read("dfes", "headroom", {"scenario": equals("scenario"), "year": equals("year")}),
    "get_assessment": Read("dnoa", "dnoa", {"licence_area": area_code("area")}),
    "get_statistics": Read("network_stats", "statistics", {"year": equals("year"), "region": equals("region")}),
    "get_demand_profiles": Read("profiles", "demand_profiles", {"profile_class": equals("profile_class")}),
    "get_dispatches": Read(
        "flexibility", "dispatches", {**_days("start_time_local"), "product": equals("product")}, until="start_time_local"
    ),
    "get_events": Read("curtailment", "events", _SITE_EVENTS, until="start_time_local"),
    "get_curtailment": Read("curtailment", "events", _SITE_EVENTS, until="start_time_local"),
    "get_embedded_capacity": Read(
        "ders",
        "ecr",
        {
            "technology_type": equals("technology_type"),
            "licence_area": equals("licence_area"),
            "min_capacity_mw": at_least("capacity_mw"),
        },
    ),
    "get_large_demand": Read(
        "ders", "large_demand", {"licence_area": equals("licence_area"), "min_demand_mw": at_least("demand_mw")}
    ),
    "get_primary_substations": Read(
        "gis",
        "grid_primary_sites",
        {"site": equals("sitefunctionallocation"), "licence_area": area("licencearea")},
        fixed=lambda: F.col("sitetype") == "Primary Substation",
    ),
    "get_secondary_sites": Read("gis", "secondary_sites", {"primary_substation": equals("primaryfeederfunctionallocation")}),
}

_AREAS = ("epn", "spn", "lpn")


class Domain:
    """Reads over a catalog: ``Domain(catalog).get_table_3a(licence_area="EPN", year=2024)``.

    Besides its own arguments a read takes the query parameters (``where``, ``select``, ``limit``, ...).
    ``limit`` is absent by default: a read is a lazy frame.
    """

    def __init__(self, catalog: Catalog):
        self.catalog = catalog

    def __getattr__(self, name: str):
        if name in READS:
            return partial(self.read, name)
        raise AttributeError(name)

    def read(self, name: str, end_inclusive_day: bool = False, where: str | Column | None = None, **params) -> DataFrame:
        spec = READS[name]
        df = self.catalog.read(spec.table, spec.group)
        cond = spec.fixed() if spec.fixed else None
        for arg, rule in spec.rules.items():
            value = params.pop(arg, None)
            if value is None:
                continue
            if arg == "end_date" and end_inclusive_day:
                cond = both(cond, F.to_date(spec.until) <= F.lit(day_literal(value)))
            else:
                cond = both(cond, rule(df, value))
        return query(df, where=merge_where(cond, where), **params)

    # --- tables chosen by argument ------------------------------------------------------------

    def get_overhead_lines(self, voltage: str = "hv", **params) -> DataFrame:
        return query(self.catalog.read(f"{voltage}_overhead_lines", "gis"), **params)

    def get_poles(self, voltage: str = "hv", **params) -> DataFrame:
        return query(self.catalog.read(f"{voltage}_poles", "gis"), **params)

    def get_circuit_data(self, voltage: str = "132kv", granularity: str = "monthly", circuit_id: str | None = None, start_date=None, end_date=None, end_inclusive_day: bool = False, where=None, **params) -> DataFrame:
        if voltage == "33kv" and granularity == "half_hourly":
            raise ValueError("33 kV circuits have monthly rows only; ask for granularity='monthly'")
        df = self.catalog.read(f"{voltage}_{granularity}", "powerflow")
        given = {"circuit_id": circuit_id, "start_date": start_date, "end_date": end_date}
        return query(df, where=merge_where(_conditions(df, {"circuit_id": equals("circuit_id"), **_days("date", end_inclusive_day)}, given), where), **params)

    def get_circuit_timeseries(self, voltage: str = "132kv", granularity: str = "monthly", circuit_id: str | None = None, **params) -> DataFrame:
        return self._timeseries(f"{voltage}_{granularity}", "circuit_id", circuit_id, **params)

    def get_transformer_timeseries(self, transformer_type: str = "primary", granularity: str = "monthly", transformer_id: str | None = None, **params) -> DataFrame:
        return self._timeseries(f"{transformer_type}_{granularity}", "transformer_id", transformer_id, **params)

    def discover_circuits(self, voltage: str = "132kv", licence_area: str | None = None, **params) -> DataFrame:
        return self.get_circuit_timeseries(voltage, "monthly", licence_area=licence_area, **params)

    def discover_transformers(self, transformer_type: str = "primary", licence_area: str | None = None, **params) -> DataFrame:
        return self.get_transformer_timeseries(transformer_type, "monthly", licence_area=licence_area, **params)

    def _route(self, key: str, licence_area: str | None) -> tuple[str, bool]:
        """Table name and whether it is the part of one area."""
        names = self.catalog.names("powerflow")
        if key in names:
            return key, False
        if licence_area is not None:
            return f"{key}_{licence_area.lower()}", True
        parts = [f"{key}_{a}" for a in _AREAS if f"{key}_{a}" in names]
        if parts:
            raise ValueError(
                f"{key!r} is kept as one table per licence area; name one with licence_area (tables: {', '.join(parts)})"
            )
        return key, False

    def _timeseries(self, key: str, id_column: str, id_value=None, licence_area: str | None = None, start_date=None, end_date=None, where=None, order_by: str | None = None, end_inclusive_day: bool = False, tiebreak: Sequence[str] = (), **params) -> DataFrame:
        name, split = self._route(key, licence_area)
        df = self.catalog.read(name, "powerflow")
        rules = {id_column: equals(id_column), "licence_area": equals("licence_area"), **_days("timestamp", end_inclusive_day)}
        given = {
            id_column: id_value,
            "licence_area": None if split else licence_area,
            "start_date": start_date,
            "end_date": end_date,
        }
        return query(df, where=merge_where(where, _conditions(df, rules, given)), order_by=order_by, tiebreak=tiebreak, **params)

    # --- substation to transformer series -----------------------------------------------------

    def substation_types(self, substation: str | None = None) -> DataFrame:
        """``(substation, licence_area, transformer_type)`` from the 2- and 3-winding tables.

        Both LV sides of a 3-winding unit count for each of its two substations.
        """
        a, b = self.catalog.read("table_2a", "ltds"), self.catalog.read("table_2b", "ltds")
        two = a.select(
            F.col("lv_substation").alias("substation"),
            detect_licence_area(a).alias("licence_area"),
            F.array(F.struct(F.col("lv_node").alias("node"), F.col("voltage_lv").cast("string").alias("kv"))).alias("sides"),
        )
        side = [F.struct(F.col(f"lv_node_{i}").alias("node"), F.col(f"voltage_lv_{i}").cast("string").alias("kv")) for i in (1, 2)]
        three = b.select(
            F.explode(F.array_distinct(F.array("lv_substation_1", "lv_substation_2"))).alias("substation"),
            detect_licence_area(b).alias("licence_area"),
            F.array(*side).alias("sides"),
        )
        rows = two.unionByName(three)
        if substation is not None:
            rows = rows.where(F.col("substation") == F.lit(substation))
        kinds = rows.select("substation", "licence_area", F.explode("sides").alias("s")).where(
            (F.col("s.node").cast("string") != "") & F.col("s.kv").isNotNull()
        )
        kind = transformer_type(parse_voltage("s.kv")).alias("transformer_type")
        return kinds.select("substation", "licence_area", kind).where(F.col("transformer_type").isNotNull()).distinct()

    def substation_area(self, substation: str) -> str | None:
        """Licence area of a substation, from any of its rows: the 2-winding table first. Looks at one row."""
        a, b = self.catalog.read("table_2a", "ltds"), self.catalog.read("table_2b", "ltds")
        two = a.where(F.col("lv_substation") == F.lit(substation)).select(F.lit(0).alias("rank"), detect_licence_area(a).alias("area"))
        either = (F.col("lv_substation_1") == F.lit(substation)) | (F.col("lv_substation_2") == F.lit(substation))
        three = b.where(either).select(F.lit(1).alias("rank"), detect_licence_area(b).alias("area"))
        row = two.unionByName(three).where(F.col("area").isNotNull()).orderBy("rank", "area").first()
        return row["area"] if row else None

    def get_half_hourly_timeseries(self, substation: str | None = None, granularity: str = "half_hourly", licence_area: str | None = None, start_date=None, end_date=None, end_inclusive_day: bool = False, where=None) -> DataFrame:
        """Series of all transformers of a substation, or of every substation when none is named.

        Ids come from the monthly tables by substation name; the series tables are reduced to them by a
        semi join, whose small side Spark measures at run time. No topology or no ids: no rows.
        """
        types = self.substation_types(substation)
        if substation is not None and licence_area is None:
            licence_area = self.substation_area(substation)
            if licence_area is None:
                raise ValueError(f"no row of {substation!r} tells its licence area; give licence_area (EPN, SPN or LPN)")
        parts = []
        wanted = None
        for kind in ("grid", "primary"):
            monthly = self._timeseries(f"{kind}_monthly", "transformer_id", licence_area=licence_area)
            names = types.where(F.col("transformer_type") == kind).select(F.col("substation").alias("ltds_name"))
            ids = monthly.join(names, "ltds_name", "left_semi").select("tx_id").where(F.col("tx_id").cast("string") != "")
            wanted = ids if wanted is None else wanted.union(ids)
        wanted = wanted.distinct()
        for kind in ("grid", "primary"):
            key = f"{kind}_{granularity}"
            for name_area in self._areas_of(key, licence_area):
                parts.append(self._timeseries(key, "transformer_id", licence_area=name_area, start_date=start_date, end_date=end_date, end_inclusive_day=end_inclusive_day, where=where))
        series = parts[0]
        for p in parts[1:]:
            series = series.unionByName(p, allowMissingColumns=True)
        return series.join(wanted, "tx_id", "left_semi")

    def _areas_of(self, key: str, licence_area: str | None) -> list[str | None]:
        names = self.catalog.names("powerflow")
        if key in names or licence_area is not None:
            return [licence_area] if key in names or f"{key}_{licence_area.lower()}" in names else []
        return [a for a in _AREAS if f"{key}_{a}" in names]


def _conditions(df: DataFrame, rules: dict[str, Rule], given: dict[str, object]) -> Column | None:
    cond = None
    for arg, rule in rules.items():
        if given.get(arg) is not None:
            cond = both(cond, rule(df, given[arg]))
    return cond
