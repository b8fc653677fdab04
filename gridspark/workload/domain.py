"""Named reads over portal-shaped tables derived from the test tables."""

from __future__ import annotations

from functools import lru_cache

from gridspark.functions.scalars import LICENCE_AREAS
from gridspark.sources.catalog import Catalog
from gridspark.sources.domain import Domain
from gridspark.workload.base import check, frame


def area(column: str) -> str:
    return f"CASE {column} % 3 " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(LICENCE_AREAS.values())) + " END"


def code(column: str) -> str:
    return f"CASE {column} % 3 WHEN 0 THEN 'EPN' WHEN 1 THEN 'SPN' ELSE 'LPN' END"


_BY_SEGMENT = f"SELECT c_custkey AS row_id, {area('c_nationkey')} AS licencearea, c_mktsegment AS substation, c_acctbal AS reading FROM {{customer}}"
_SERIES = "l_orderkey, l_linenumber, l_suppkey AS tx_id, CAST(l_suppkey AS STRING) AS transformer_id, l_shipdate AS timestamp, l_quantity AS active_power_mw"

# One binding per published table, by group and name.
PORTAL: dict[tuple[str, str], str] = {
    ("ltds", "table_1"): _BY_SEGMENT,
    ("ltds", "table_2a"): f"""SELECT s_suppkey AS row_id, {area('s_nationkey')} AS licencearea, s_name AS lv_substation, 'GSP' || CAST(s_nationkey AS STRING) AS hv_substation,
        CASE WHEN s_suppkey % 10 = 0 THEN '' ELSE 'N' || CAST(s_suppkey AS STRING) END AS lv_node, CAST(s_nationkey + 11 AS STRING) || 'kV' AS voltage_lv FROM {{supplier}}""",
    ("ltds", "table_2b"): f"""SELECT s_suppkey AS row_id, {area('s_nationkey')} AS licencearea, 'GSP' || CAST(s_nationkey AS STRING) AS hv_substation,
        s_name AS lv_substation_1, 'Twin ' || s_name AS lv_substation_2, 'M' || CAST(s_suppkey AS STRING) AS lv_node_1, 'T' || CAST(s_suppkey AS STRING) AS lv_node_2,
        CASE WHEN s_suppkey % 4 = 0 THEN '33kV' END AS voltage_lv_1, CASE WHEN s_suppkey % 4 = 1 THEN '11' END AS voltage_lv_2 FROM {{supplier}}""",
    ("ltds", "table_3a"): f"""SELECT c_custkey AS row_id, {area('c_nationkey')} AS licencearea, c_mktsegment AS substation, 2020 + c_custkey % 5 AS year, c_acctbal AS demand FROM {{customer}}""",
    ("ltds", "table_3b"): _BY_SEGMENT,
    ("ltds", "table_4a"): _BY_SEGMENT,
    ("ltds", "table_4b"): _BY_SEGMENT,
    ("ltds", "table_5"): f"""SELECT p_partkey AS row_id, {area('p_size')} AS licencearea, p_brand AS substation, p_type AS fuel_type, p_retailprice AS installedcapacity_mva FROM {{part}}""",
    ("ltds", "table_6"): _BY_SEGMENT,
    ("ltds", "table_7"): _BY_SEGMENT,
    ("ltds", "table_8"): _BY_SEGMENT,
    ("ltds", "projects"): f"""SELECT o_orderkey AS row_id, {code('o_custkey')} AS dno, o_orderpriority AS local_authority, year(o_orderdate) AS expected_start_year FROM {{orders}}""",
    ("dfes", "headroom"): "SELECT o_orderkey AS row_id, o_orderpriority AS scenario, year(o_orderdate) AS year, o_totalprice AS headroom_mw FROM {orders}",
    ("dnoa", "dnoa"): f"SELECT c_custkey AS row_id, {code('c_nationkey')} AS area, c_mktsegment AS dnoa_result FROM {{customer}}",
    ("network_stats", "statistics"): "SELECT o_orderkey AS row_id, year(o_orderdate) AS year, o_orderstatus AS region FROM {orders}",
    ("profiles", "demand_profiles"): "SELECT p_partkey AS row_id, p_brand AS profile_class FROM {part}",
    ("powerflow", "132kv_monthly"): f"SELECT o_orderkey AS row_id, CAST(o_custkey AS STRING) AS circuit_id, {code('o_custkey')} AS licence_area, CAST(o_orderdate AS DATE) AS date, o_orderdate AS timestamp FROM {{orders}}",
    ("powerflow", "132kv_half_hourly"): f"SELECT event_id AS row_id, CAST(user_id AS STRING) AS circuit_id, {code('user_id')} AS licence_area, CAST(ts AS DATE) AS date, ts AS timestamp FROM {{events}}",
    ("powerflow", "33kv_half_hourly_epn"): "SELECT event_id AS row_id, CAST(user_id AS STRING) AS circuit_id, ts AS timestamp FROM {events} WHERE user_id % 3 = 0",
    ("powerflow", "33kv_half_hourly_spn"): "SELECT event_id AS row_id, CAST(user_id AS STRING) AS circuit_id, ts AS timestamp FROM {events} WHERE user_id % 3 <> 0",
    ("powerflow", "grid_monthly"): f"""SELECT DISTINCT l_suppkey AS tx_id, CAST(l_suppkey AS STRING) AS transformer_id, s_name AS ltds_name, {code('s_nationkey')} AS licence_area,
        date_trunc('month', l_shipdate) AS timestamp FROM {{lineitem}} JOIN {{supplier}} ON l_suppkey = s_suppkey WHERE l_linenumber % 2 = 0""",
    ("powerflow", "primary_monthly"): f"""SELECT DISTINCT l_suppkey AS tx_id, CAST(l_suppkey AS STRING) AS transformer_id, s_name AS ltds_name, {code('s_nationkey')} AS licence_area,
        date_trunc('month', l_shipdate) AS timestamp FROM {{lineitem}} JOIN {{supplier}} ON l_suppkey = s_suppkey WHERE l_linenumber % 2 = 1""",
    ("powerflow", "grid_half_hourly"): f"SELECT {_SERIES}, {code('l_suppkey')} AS licence_area FROM {{lineitem}} WHERE l_linenumber % 2 = 0",
    ("powerflow", "primary_half_hourly_epn"): f"SELECT {_SERIES} FROM {{lineitem}} WHERE l_linenumber % 2 = 1 AND l_suppkey % 3 = 0",
    ("powerflow", "primary_half_hourly_spn"): f"SELECT {_SERIES} FROM {{lineitem}} WHERE l_linenumber % 2 = 1 AND l_suppkey % 3 <> 0",
    ("flexibility", "dispatches"): "SELECT event_id AS row_id, ts AS start_time_local, event_type AS product FROM {events}",
    ("curtailment", "events"): "SELECT event_id AS row_id, ts AS start_time_local, event_type AS driver, 'site ' || CAST(user_id AS STRING) AS der_name FROM {events}",
    ("ders", "ecr"): f"SELECT s_suppkey AS row_id, CASE WHEN s_suppkey % 2 = 0 THEN 'Solar' ELSE 'Wind' END AS technology_type, {code('s_nationkey')} AS licence_area, s_acctbal AS capacity_mw FROM {{supplier}}",
    ("ders", "large_demand"): f"SELECT c_custkey AS row_id, {code('c_nationkey')} AS licence_area, c_acctbal AS demand_mw FROM {{customer}}",
    ("gis", "grid_primary_sites"): f"""SELECT c_custkey AS row_id, CASE WHEN c_custkey % 4 = 0 THEN 'Grid Substation' ELSE 'Primary Substation' END AS sitetype,
        'S' || CAST(c_custkey % 50 AS STRING) AS sitefunctionallocation, {area('c_nationkey')} AS licencearea FROM {{customer}}""",
    ("gis", "secondary_sites"): "SELECT c_custkey AS row_id, 'S' || CAST(c_custkey % 50 AS STRING) AS primaryfeederfunctionallocation FROM {customer}",
    ("gis", "hv_overhead_lines"): "SELECT o_orderkey AS row_id FROM {orders}",
    ("gis", "lv_poles"): "SELECT l_orderkey AS row_id, l_linenumber AS part FROM {lineitem}",
}


def catalog(spark, sf) -> Catalog:
    out = Catalog(spark)
    for (group, name), binding in PORTAL.items():
        out.register(name, lambda b=binding: frame(spark, sf, b), group)
    return out


def _sql(table: tuple[str, str], where: str, columns: str = "row_id") -> str:
    binding = PORTAL[table].replace("AS STRING", "AS VARCHAR")
    return f"SELECT {columns} FROM ({binding}) t WHERE {where}"


FULL = {c: f"licencearea = '{n}'" for c, n in LICENCE_AREAS.items()}

# (query, table, read, arguments, condition)
READ_CHECKS = [
    ("circuits", ("ltds", "table_1"), "get_table_1", {"licence_area": "EPN"}, FULL["EPN"]),
    ("transformers_2w", ("ltds", "table_2a"), "get_table_2a", {"licence_area": "spn", "substation": "Supplier#000000002"}, f"{FULL['SPN']} AND lv_substation = 'Supplier#000000002'"),
    ("transformers_2w_area", ("ltds", "table_2a"), "get_table_2a", {"licence_area": "lpn"}, FULL["LPN"]),
    ("transformers_3w", ("ltds", "table_2b"), "get_table_2b", {"substation": "Twin Supplier#000000007"}, "lv_substation_1 = 'Twin Supplier#000000007' OR lv_substation_2 = 'Twin Supplier#000000007'"),
    ("observed_demand", ("ltds", "table_3a"), "get_table_3a", {"licence_area": "EPN", "year": 2024}, f"{FULL['EPN']} AND year = 2024"),
    ("true_demand", ("ltds", "table_3b"), "get_table_3b", {"licence_area": "SPN"}, FULL["SPN"]),
    ("fault_level_3ph", ("ltds", "table_4a"), "get_table_4a", {"licence_area": "LPN"}, FULL["LPN"]),
    ("fault_level_earth", ("ltds", "table_4b"), "get_table_4b", {"licence_area": LICENCE_AREAS["EPN"]}, FULL["EPN"]),
    ("generation", ("ltds", "table_5"), "get_table_5", {"licence_area": "EPN", "fuel_type": "ECONOMY", "substation": "Brand#11"}, f"{FULL['EPN']} AND fuel_type LIKE '%ECONOMY%' AND substation = 'Brand#11'"),
    ("generation_fuel", ("ltds", "table_5"), "get_table_5", {"fuel_type": "PROMO"}, "fuel_type LIKE '%PROMO%'"),
    ("connection_queue", ("ltds", "table_6"), "get_table_6", {"licence_area": "SPN", "substation": "BUILDING"}, f"{FULL['SPN']} AND substation = 'BUILDING'"),
    ("restrictions", ("ltds", "table_7"), "get_table_7", {"licence_area": "EPN"}, FULL["EPN"]),
    ("fault_data", ("ltds", "table_8"), "get_table_8", {"licence_area": "EPN", "where": "reading > 0 OR substation = 'BUILDING'"}, f"{FULL['EPN']} AND (reading > 0 OR substation = 'BUILDING')"),
    ("projects", ("ltds", "projects"), "get_projects", {"licence_area": "EPN", "local_authority": "HIGH", "expected_start_year": 1997}, "dno = 'EPN' AND local_authority LIKE '%HIGH%' AND expected_start_year = 1997"),
    ("headroom", ("dfes", "headroom"), "get_headroom", {"scenario": "3-MEDIUM", "year": 1998, "where": "headroom_mw > 100000"}, "scenario = '3-MEDIUM' AND year = 1998 AND headroom_mw > 100000"),
    ("options_assessment", ("dnoa", "dnoa"), "get_assessment", {"licence_area": "EPN"}, "area = 'EPN'"),
    ("circuit_data", ("powerflow", "132kv_monthly"), "get_circuit_data", {"circuit_id": "7", "start_date": "1995-06-01", "end_date": "1999-12-31"}, "circuit_id = '7' AND date >= DATE '1995-06-01' AND date <= DATE '1999-12-31'"),
    ("circuit_data_range", ("powerflow", "132kv_monthly"), "get_circuit_data", {"start_date": "1996-01-01", "end_date": "1996-03-31"}, "date >= DATE '1996-01-01' AND date <= DATE '1996-03-31'"),
    ("network_statistics", ("network_stats", "statistics"), "get_statistics", {"year": 1999, "region": "O"}, "year = 1999 AND region = 'O'"),
    ("demand_profiles", ("profiles", "demand_profiles"), "get_demand_profiles", {"profile_class": "Brand#23"}, "profile_class = 'Brand#23'"),
    ("dispatches", ("flexibility", "dispatches"), "get_dispatches", {"start_date": "2024-01-05", "end_date": "2024-01-20T10:00:00Z", "product": "click"}, "start_time_local >= TIMESTAMP '2024-01-05' AND start_time_local <= TIMESTAMP '2024-01-20' AND product = 'click'"),
    ("dispatches_whole_day", ("flexibility", "dispatches"), "get_dispatches", {"end_date": "2024-01-20", "end_inclusive_day": True}, "start_time_local < TIMESTAMP '2024-01-21'"),
    ("curtailment_events", ("curtailment", "events"), "get_events", {"site_id": "site 12", "start_date": "2024-01-02", "driver": "view"}, "der_name = 'site 12' AND start_time_local >= TIMESTAMP '2024-01-02' AND driver = 'view'"),
    ("curtailment_alias", ("curtailment", "events"), "get_curtailment", {"site_id": "site 3", "end_date": "2024-01-25"}, "der_name = 'site 3' AND start_time_local <= TIMESTAMP '2024-01-25'"),
    ("embedded_capacity", ("ders", "ecr"), "get_embedded_capacity", {"technology_type": "Solar", "licence_area": "EPN", "min_capacity_mw": 100.0}, "technology_type = 'Solar' AND licence_area = 'EPN' AND capacity_mw >= 100"),
    ("large_demand", ("ders", "large_demand"), "get_large_demand", {"licence_area": "SPN", "min_demand_mw": 5000.0}, "licence_area = 'SPN' AND demand_mw >= 5000"),
    ("primary_substations", ("gis", "grid_primary_sites"), "get_primary_substations", {"site": "S11", "licence_area": "EPN"}, f"sitetype = 'Primary Substation' AND sitefunctionallocation = 'S11' AND {FULL['EPN']}"),
    ("primary_substations_all", ("gis", "grid_primary_sites"), "get_primary_substations", {}, "sitetype = 'Primary Substation'"),
    ("secondary_sites", ("gis", "secondary_sites"), "get_secondary_sites", {"primary_substation": "S9"}, "primaryfeederfunctionallocation = 'S9'"),
    ("overhead_lines", ("gis", "hv_overhead_lines"), "get_overhead_lines", {"voltage": "hv"}, "true"),
    ("circuit_timeseries", ("powerflow", "132kv_half_hourly"), "get_circuit_timeseries", {"granularity": "half_hourly", "licence_area": "EPN", "start_date": "2024-01-03", "end_date": "2024-01-19"}, "licence_area = 'EPN' AND timestamp >= TIMESTAMP '2024-01-03' AND timestamp <= TIMESTAMP '2024-01-19'"),
    ("circuit_timeseries_split", ("powerflow", "33kv_half_hourly_spn"), "get_circuit_timeseries", {"voltage": "33kv", "granularity": "half_hourly", "licence_area": "SPN", "start_date": "2024-01-10"}, "timestamp >= TIMESTAMP '2024-01-10'"),
    ("discover_circuits", ("powerflow", "132kv_monthly"), "discover_circuits", {"licence_area": "LPN"}, "licence_area = 'LPN'"),
]

for _name, _table, _read, _args, _where in READ_CHECKS:

    @check(_name, _sql(_table, _where))
    def _(spark, sf, read=_read, args=_args):
        return getattr(Domain(catalog(spark, sf)), read)(**args).select("row_id")


@check("poles", _sql(("gis", "lv_poles"), "true", "row_id, CAST(part AS BIGINT) AS part"))
def _(spark, sf):
    return Domain(catalog(spark, sf)).get_poles("lv")


_POINT = "l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, tx_id, timestamp, ROUND(active_power_mw, 4) AS active_power_mw"


@check("transformer_timeseries", _sql(("powerflow", "primary_half_hourly_epn"), "transformer_id = '6' AND timestamp >= TIMESTAMP '1996-01-01'", _POINT), digits=4)
def _(spark, sf):
    out = Domain(catalog(spark, sf)).get_transformer_timeseries("primary", "half_hourly", "6", licence_area="EPN", start_date="1996-01-01")
    return out.select("l_orderkey", "l_linenumber", "tx_id", "timestamp", "active_power_mw")


@check("discover_transformers", _sql(("powerflow", "grid_monthly"), "licence_area = 'SPN'", "tx_id, ltds_name, CAST(timestamp AS TIMESTAMP) AS timestamp"))
def _(spark, sf):
    return Domain(catalog(spark, sf)).discover_transformers("grid", "SPN").select("tx_id", "ltds_name", "timestamp")


@lru_cache
def _pipeline_sql(substation: str | None, area_code: str | None, condition: str) -> str:
    b = {k: PORTAL[("powerflow", k)].replace("AS STRING", "AS VARCHAR") for k in ("grid_monthly", "primary_monthly", "grid_half_hourly", "primary_half_hourly_epn", "primary_half_hourly_spn")}
    a, t = (PORTAL[("ltds", k)].replace("AS STRING", "AS VARCHAR") for k in ("table_2a", "table_2b"))
    only = f"WHERE substation = '{substation}'" if substation else ""
    month = f"licence_area = '{area_code}'" if area_code else "true"
    parts = [f"SELECT {_POINT}, licence_area FROM ({b['grid_half_hourly']}) g WHERE {month}"]
    for part in ("epn", "spn"):
        if area_code in (None, part.upper()):
            parts.append(f"SELECT {_POINT}, NULL AS licence_area FROM ({b[f'primary_half_hourly_{part}']}) p")
    return f"""WITH a AS ({a}), t AS ({t}),
      sides AS (SELECT lv_substation AS substation, lv_node AS node, voltage_lv AS kv FROM a
        UNION ALL SELECT lv_substation_1, lv_node_1, voltage_lv_1 FROM t UNION ALL SELECT lv_substation_1, lv_node_2, voltage_lv_2 FROM t
        UNION ALL SELECT lv_substation_2, lv_node_1, voltage_lv_1 FROM t UNION ALL SELECT lv_substation_2, lv_node_2, voltage_lv_2 FROM t),
      kinds AS (SELECT DISTINCT substation, CASE WHEN TRY_CAST(replace(lower(kv), 'kv', '') AS DOUBLE) >= 22 THEN 'grid' ELSE 'primary' END AS kind
        FROM (SELECT * FROM sides {only}) x WHERE node <> '' AND kv IS NOT NULL),
      ids AS (SELECT tx_id FROM ({b['grid_monthly']}) m WHERE {month} AND ltds_name IN (SELECT substation FROM kinds WHERE kind = 'grid')
        UNION SELECT tx_id FROM ({b['primary_monthly']}) m WHERE {month} AND ltds_name IN (SELECT substation FROM kinds WHERE kind = 'primary')),
      series AS ({' UNION ALL '.join(parts)})
      SELECT l_orderkey, l_linenumber, tx_id, timestamp, active_power_mw FROM series WHERE tx_id IN (SELECT tx_id FROM ids) AND {condition}"""


_SERIES_COLUMNS = ("l_orderkey", "l_linenumber", "tx_id", "timestamp", "active_power_mw")


@check("substation_series", _pipeline_sql("Supplier#000000000", "EPN", "timestamp >= TIMESTAMP '1996-01-01' AND active_power_mw > 5"), digits=4)
def _(spark, sf):
    out = Domain(catalog(spark, sf)).get_half_hourly_timeseries("Supplier#000000000", licence_area="EPN", start_date="1996-01-01", where="active_power_mw > 5")
    return out.select(*_SERIES_COLUMNS)


@check("substation_series_all", _pipeline_sql(None, None, "timestamp <= TIMESTAMP '2000-12-31'"), digits=4)
def _(spark, sf):
    out = Domain(catalog(spark, sf)).get_half_hourly_timeseries(end_date="2000-12-31")
    return out.select(*_SERIES_COLUMNS)
