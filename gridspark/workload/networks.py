"""Network tables, ratings and flexibility need."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridspark.operators import capacity as cp
from gridspark.operators import network as nw
from gridspark.sources.staging import new_path
from gridspark.workload.base import check, frame
from gridspark.workload.domain import PORTAL

T2A, T2B = PORTAL[("ltds", "table_2a")], PORTAL[("ltds", "table_2b")]


def _sql(binding: str) -> str:
    return binding.replace("AS STRING", "AS VARCHAR")


@check(
    "topology_nodes",
    f"""WITH a AS ({_sql(T2A)}), t AS ({_sql(T2B)}),
        n AS (SELECT lv_node, voltage_lv, lv_substation, hv_substation FROM a
              UNION ALL SELECT lv_node_1, voltage_lv_1, lv_substation_1, hv_substation FROM t
              UNION ALL SELECT lv_node_2, voltage_lv_2, lv_substation_2, hv_substation FROM t)
        SELECT * FROM n WHERE lv_node <> '' AND voltage_lv IS NOT NULL""",
)
def _(spark, sf):
    return nw.topology_nodes(frame(spark, sf, T2A), frame(spark, sf, T2B))


# Units between brands: the HV side is a brand of low number, so some substations are on both sides.
UNITS = """SELECT p_partkey AS unit, 'B' || CAST(p_size % 6 AS STRING) AS hv_substation, 'B' || CAST(p_size % 17 AS STRING) || CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE '' END AS lv_substation,
   33.0D + p_size % 3 AS voltage_hv, 11.0D + p_partkey % 2 AS voltage_lv, p_retailprice AS transformer_rating_mva_winter,
   CASE WHEN p_partkey % 8 = 0 THEN 0.0D ELSE p_retailprice * 0.9D END AS transformer_rating_mva_summer,
   p_size / 10.0D AS positive_sequence_impedance_r_percent, p_size * 1.5D AS positive_sequence_impedance_x_percent FROM {part}"""
UNITS_SQL = UNITS.replace("AS STRING", "AS VARCHAR").replace("33.0D", "33.0::DOUBLE").replace("11.0D", "11.0::DOUBLE").replace("0.0D", "0.0::DOUBLE").replace("0.9D", "0.9::DOUBLE").replace("10.0D", "10.0::DOUBLE").replace("1.5D", "1.5::DOUBLE")
NODES_SQL = f"""SELECT node, arg_max(kv, rank * 1000 + kv) AS vn_kv FROM (
    SELECT hv_substation AS node, 1 AS rank, voltage_hv AS kv FROM ({UNITS_SQL}) u
    UNION ALL SELECT lv_substation, 0, voltage_lv FROM ({UNITS_SQL}) u) x WHERE node IS NOT NULL GROUP BY node"""


@check("node_table", NODES_SQL)
def _(spark, sf):
    return nw.node_table(frame(spark, sf, UNITS))


@check(
    "transformer_edges",
    f"""SELECT hv_substation AS hv_node, lv_substation AS lv_node, ROUND(transformer_rating_mva_winter, 6) AS sn_mva, voltage_hv AS vn_hv_kv, voltage_lv AS vn_lv_kv,
        ROUND(sqrt(power(positive_sequence_impedance_r_percent / 100, 2) + power(positive_sequence_impedance_x_percent / 100, 2)), 6) AS vk,
        ROUND(positive_sequence_impedance_r_percent / 100, 6) AS vkr FROM ({UNITS_SQL}) u""",
)
def _(spark, sf):
    return nw.transformer_edges(frame(spark, sf, UNITS))


OHMS = "SELECT p_partkey, p_size * 1.0D AS hv_kv, p_retailprice AS sn_mva, p_size / 7.0D AS r_ohm, p_size / 3.0D AS x_ohm FROM {part}"
OHMS_SQL = OHMS.replace("1.0D", "1.0::DOUBLE").replace("7.0D", "7.0::DOUBLE").replace("3.0D", "3.0::DOUBLE")


@check(
    "percent_impedance",
    f"""SELECT p_partkey, ROUND(r_ohm / (hv_kv * hv_kv / sn_mva) * 100, 4) AS vkr_percent, ROUND(x_ohm / (hv_kv * hv_kv / sn_mva) * 100, 4) AS vkx_percent,
        ROUND(sqrt(power(r_ohm / (hv_kv * hv_kv / sn_mva) * 100, 2) + power(x_ohm / (hv_kv * hv_kv / sn_mva) * 100, 2)), 4) AS vk_percent FROM ({OHMS_SQL}) x WHERE hv_kv > 0""",
    digits=4,
)
def _(spark, sf):
    rows = frame(spark, sf, OHMS).where("hv_kv > 0")
    return nw.percent_impedance(rows).select("p_partkey", "vkr_percent", "vkx_percent", "vk_percent")


DEMAND = """SELECT o_orderkey, 'B' || CAST(o_custkey % 23 AS STRING) AS substation, CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_totalprice / 1000 END AS maximum_demand_24_25_mw,
   CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE 0.9D END AS maximum_demand_24_25_pf FROM {orders}"""
DEMAND_SQL = DEMAND.replace("AS STRING", "AS VARCHAR").replace("0.9D", "0.9::DOUBLE")


@check(
    "load_table",
    f"""SELECT d.substation, ROUND(maximum_demand_24_25_mw, 6) AS p_mw, ROUND(maximum_demand_24_25_mw * tan(acos(COALESCE(maximum_demand_24_25_pf, 0.95::DOUBLE))), 6) AS q_mvar, n.vn_kv
        FROM ({DEMAND_SQL}) d JOIN ({NODES_SQL}) n ON n.node = d.substation WHERE maximum_demand_24_25_mw IS NOT NULL""",
    digits=6,
)
def _(spark, sf):
    return nw.load_table(frame(spark, sf, DEMAND), nw.node_table(frame(spark, sf, UNITS)))


GENERATION = "SELECT 'B' || CAST(o_custkey % 23 AS STRING) AS substation, o_totalprice AS installedcapacity_mva FROM {orders}"


@check(
    "generation_per_node",
    f"SELECT g.substation, ROUND(SUM(installedcapacity_mva), 2) AS p_mw, ANY_VALUE(n.vn_kv) AS vn_kv FROM ({_sql(GENERATION)}) g JOIN ({NODES_SQL}) n ON n.node = g.substation GROUP BY 1",
    digits=2,
)
def _(spark, sf):
    return nw.generation_table(frame(spark, sf, GENERATION), nw.node_table(frame(spark, sf, UNITS)))


@check("supply_node", f"SELECT node, vn_kv FROM ({NODES_SQL}) n ORDER BY vn_kv DESC, node LIMIT 1")
def _(spark, sf):
    return nw.supply_node(nw.node_table(frame(spark, sf, UNITS)))


# Model classes as tables: orders are transformers, their lines the ends, nations voltage levels, regions substations.
MODEL = {
    "units": "SELECT CAST(o_orderkey AS STRING) AS id, o_orderpriority AS name, CASE WHEN o_custkey % 5 = 0 THEN 'none' ELSE 'VL' || CAST(o_custkey % 25 AS STRING) END AS container FROM {orders}",
    "ends": """SELECT CAST(l_orderkey AS STRING) AS transformer_id, CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS id, l_linenumber * 10000000000 + l_partkey * 10000 + l_suppkey AS end_number,
        CASE WHEN l_quantity < 3 THEN 0.0D ELSE l_quantity END AS rated_s_mva, l_extendedprice AS rated_u_kv, l_discount AS r_ohm,
        CASE WHEN l_tax = 0 THEN NULL ELSE l_tax END AS x_ohm, CASE WHEN l_suppkey % 3 = 0 THEN NULL ELSE 'BV' || CAST(l_suppkey % 4 AS STRING) END AS base_voltage_id
        FROM {lineitem}""",
    "volts": "SELECT 'BV' || CAST(r_regionkey AS STRING) AS id, r_regionkey * 11.0D AS base_kv FROM {region}",
    "subs": "SELECT 'S' || CAST(r_regionkey AS STRING) AS id, r_name AS name FROM {region}",
    "levels": "SELECT 'VL' || CAST(n_nationkey AS STRING) AS id, 'S' || CAST(n_regionkey AS STRING) AS substation_id FROM {nation}",
}
_M = {k: v.replace("AS STRING", "AS VARCHAR").replace("0.0D", "0.0::DOUBLE").replace("11.0D", "11.0::DOUBLE") for k, v in MODEL.items()}
ENDS_SQL = f"""WITH units AS ({_M['units']}), ends AS ({_M['ends']}), volts AS ({_M['volts']}), subs AS ({_M['subs']}), levels AS ({_M['levels']}),
   places AS (SELECT id AS container, name AS substation FROM subs UNION ALL SELECT levels.id, subs.name FROM levels JOIN subs ON subs.id = levels.substation_id),
   full_ends AS (SELECT ends.transformer_id, units.name, COALESCE(places.substation, 'Unknown') AS substation, end_number, rated_s_mva, rated_u_kv, r_ohm, x_ohm, base_kv
      FROM ends JOIN units ON units.id = ends.transformer_id LEFT JOIN volts ON volts.id = ends.base_voltage_id LEFT JOIN places ON places.container = units.container)"""


def model_ends(spark, sf):
    m = {k: frame(spark, sf, v) for k, v in MODEL.items()}
    places = nw.container_names(m["subs"], m["levels"])
    return nw.transformer_ends(m["units"], m["ends"], m["volts"], places)


@check("transformer_ends", f"{ENDS_SQL} SELECT transformer_id, name, substation, end_number, ROUND(rated_s_mva, 4) AS rated_s_mva, ROUND(base_kv, 4) AS base_kv FROM full_ends", digits=4)
def _(spark, sf):
    return model_ends(spark, sf).select("transformer_id", "name", "substation", "end_number", "rated_s_mva", "base_kv")


@check(
    "usable_transformers",
    f"""{ENDS_SQL}, r AS (SELECT *, COUNT(*) OVER (PARTITION BY transformer_id) AS n, ROW_NUMBER() OVER (PARTITION BY transformer_id ORDER BY end_number) AS rn FROM full_ends)
        SELECT h.transformer_id, h.name, h.substation, ROUND(h.rated_u_kv, 4) AS hv_kv, ROUND(l.rated_u_kv, 4) AS lv_kv, ROUND(h.rated_s_mva, 4) AS sn_mva, ROUND(h.r_ohm, 4) AS r_ohm, ROUND(h.x_ohm, 4) AS x_ohm
        FROM r h JOIN r l ON l.transformer_id = h.transformer_id AND h.rn = 1 AND l.rn = 2 WHERE h.n = 2 AND h.rated_s_mva <> 0 AND h.rated_u_kv <> 0 AND h.x_ohm <> 0""",
    digits=4,
)
def _(spark, sf):
    return nw.usable_transformers(model_ends(spark, sf))


@check(
    "usable_units",
    f"""{ENDS_SQL}, r AS (SELECT *, COUNT(*) OVER (PARTITION BY transformer_id) AS n, ROW_NUMBER() OVER (PARTITION BY transformer_id ORDER BY end_number) AS rn FROM full_ends)
        SELECT h.transformer_id, h.name, h.substation, ROUND(h.rated_u_kv, 4) AS hv_kv, ROUND(l.rated_u_kv, 4) AS lv_kv, ROUND(h.rated_s_mva, 4) AS sn_mva, ROUND(h.r_ohm, 4) AS r_ohm, ROUND(h.x_ohm, 4) AS x_ohm
        FROM r h JOIN r l ON l.transformer_id = h.transformer_id AND h.rn = 1 AND l.rn = 2 WHERE h.n = 2 AND h.rated_s_mva <> 0 AND h.rated_u_kv <> 0 AND h.x_ohm <> 0""",
    digits=4,
)
def _(spark, sf):
    m = {k: frame(spark, sf, v) for k, v in MODEL.items()}
    return nw.usable_units(m["units"], m["ends"], nw.container_names(m["subs"], m["levels"]))


@check(
    "class_capacity_totals",
    """SELECT 'PhotoVoltaicUnit' AS class, COUNT(*) AS units, ROUND(SUM(p_retailprice), 2) AS total_mw FROM {part}
       UNION ALL SELECT 'BatteryUnit', COUNT(*), ROUND(SUM(s_acctbal), 2) FROM {supplier}""",
    digits=2,
)
def _(spark, sf):
    pv = frame(spark, sf, "SELECT p_name AS name, p_retailprice AS max_p_mw FROM {part}")
    battery = frame(spark, sf, "SELECT s_name AS name, s_acctbal AS max_p_mw FROM {supplier}")
    return nw.capacity_totals({"PhotoVoltaicUnit": pv, "BatteryUnit": battery})


def model_text(spark, sf) -> str:
    """Customers as consumers, parts as transformers with an end each, suppliers as generating units, as model XML."""

    def name(c):
        return f"'<cim:IdentifiedObject.name>' || replace({c}, '&', '&amp;') || '</cim:IdentifiedObject.name>'"

    lines = [
        f"""SELECT '<cim:EnergyConsumer rdf:ID="_c' || c_custkey || '">' || {name("c_name")} || '<cim:Equipment.EquipmentContainer rdf:resource="#_n' || c_nationkey || '"/></cim:EnergyConsumer>' AS value FROM {{customer}}""",
        f"""SELECT '<cim:PowerTransformer rdf:ID="_p' || p_partkey || '">' || {name("p_name || ' & co'")} || '</cim:PowerTransformer>
  <cim:PowerTransformerEnd rdf:about="#_e' || p_partkey || '"><cim:PowerTransformerEnd.PowerTransformer rdf:resource="#_p' || p_partkey || '"/>
    <cim:TransformerEnd.endNumber>' || p_size || '</cim:TransformerEnd.endNumber><cim:PowerTransformerEnd.ratedS>' || CAST(p_partkey % 7 AS DOUBLE) || '</cim:PowerTransformerEnd.ratedS></cim:PowerTransformerEnd>' FROM {{part}}""",
        f"""SELECT '<cim:WindGeneratingUnit rdf:ID="_s' || s_suppkey || '">' || {name("s_name")} || CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE '<cim:GeneratingUnit.maxOperatingP>' || CAST(s_suppkey AS DOUBLE) / 4 || '</cim:GeneratingUnit.maxOperatingP>' END || '</cim:WindGeneratingUnit>' FROM {{supplier}}""",
    ]
    path = new_path(spark, "model_text")
    frame(spark, sf, " UNION ALL ".join(lines)).write.text(path)
    return path


@check(
    "model_classes",
    """SELECT 'EnergyConsumer' AS class, 'c' || c_custkey AS id, c_name AS name, 'n' || c_nationkey AS ref, NULL::DOUBLE AS number, NULL::BIGINT AS whole FROM {customer}
       UNION ALL SELECT 'PowerTransformer', 'p' || p_partkey, p_name || ' & co', NULL, NULL, NULL FROM {part}
       UNION ALL SELECT 'PowerTransformerEnd', 'e' || p_partkey, NULL, 'p' || p_partkey, p_partkey % 7, p_size FROM {part}
       UNION ALL SELECT 'WindGeneratingUnit', 's' || s_suppkey, s_name, NULL, CASE WHEN s_suppkey % 3 <> 0 THEN s_suppkey / 4 END, NULL FROM {supplier}""",
)
def _(spark, sf):
    model = nw.read_model(spark, model_text(spark, sf), ("EnergyConsumer", "PowerTransformer", "PowerTransformerEnd", "WindGeneratingUnit"))
    columns = {"name": ("name", "string"), "container": ("ref", "string"), "transformer_id": ("ref", "string"), "rated_s_mva": ("number", "double"), "max_p_mw": ("number", "double"), "end_number": ("whole", "long")}
    out = None
    for name, df in model.items():
        found = {to: F.col(c).cast(kind) for c, (to, kind) in columns.items() if c in df.columns and not (name == "PowerTransformer" and c == "container")}
        cells = [found.get(to, F.lit(None).cast(kind)).alias(to) for to, kind in (("name", "string"), ("ref", "string"), ("number", "double"), ("whole", "long"))]
        rows = df.select(F.lit(name).alias("class"), "id", *cells)
        out = rows if out is None else out.unionByName(rows)
    return out


@check(
    "element_counts",
    """SELECT 'EnergyConsumer' AS class, COUNT(*) AS count FROM {customer} UNION ALL SELECT 'PowerTransformer', COUNT(*) FROM {part}
       UNION ALL SELECT 'PowerTransformerEnd', COUNT(*) FROM {part} UNION ALL SELECT 'WindGeneratingUnit', COUNT(*) FROM {supplier}""",
)
def _(spark, sf):
    return nw.model_counts(nw.shred_model(spark, model_text(spark, sf)))


# --- ratings and need -------------------------------------------------------------------------

THREE = """SELECT 'B' || CAST(s_nationkey % 6 AS STRING) AS hv_substation, s_name AS lv_substation_1, s_name AS lv_substation_2,
   CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE s_acctbal END AS transformer_rating_mva_winter_hv, CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE s_acctbal / 2 END AS transformer_rating_mva_summer_hv FROM {supplier}"""
RATINGS_SQL = f"""SELECT lv_substation AS substation, NULLIF(transformer_rating_mva_winter, 0) AS w, NULLIF(transformer_rating_mva_summer, 0) AS s FROM ({UNITS_SQL}) u
   UNION ALL SELECT hv_substation, NULLIF(transformer_rating_mva_winter_hv, 0), NULLIF(transformer_rating_mva_summer_hv, 0) FROM ({_sql(THREE)}) t"""


@check(
    "n_minus_1_rating",
    f"""SELECT substation, COUNT(*) AS units, ROUND(SUM(w) - MAX(w), 4) AS n_minus_1_mva_winter, ROUND((SUM(w) - MAX(w)) * 0.97, 4) AS n_minus_1_mw_winter,
        ROUND(SUM(s) - MAX(s), 4) AS n_minus_1_mva_summer, ROUND((SUM(s) - MAX(s)) * 0.97, 4) AS n_minus_1_mw_summer
        FROM ({RATINGS_SQL}) r WHERE w IS NOT NULL OR s IS NOT NULL GROUP BY 1""",
    digits=4,
)
def _(spark, sf):
    return cp.n_minus_1_rating(cp.transformer_ratings(frame(spark, sf, UNITS), frame(spark, sf, THREE)))


LOADS = "SELECT o_orderpriority AS key, o_orderdate AS ts, o_totalprice AS actual, o_totalprice * 0.9D AS forecast, o_totalprice * 1.1D AS p90 FROM {orders}"
LOADS_SQL = LOADS.replace("0.9D", "0.9::DOUBLE").replace("1.1D", "1.1::DOUBLE")
LIMITS = "SELECT o_orderpriority AS key, AVG(o_totalprice) * 1.6D AS n_minus_1_mw_winter FROM {orders} GROUP BY 1"
PEAKS_SQL = f"SELECT key, CAST(ts AS DATE) AS day, MAX(actual) AS actual_peak, MAX(forecast) AS forecast_peak, MAX(p90) AS p90_peak FROM ({LOADS_SQL}) l GROUP BY 1, 2"
DAYS_SQL = f"""SELECT p.*, r.n_minus_1_mw_winter AS rating_mw, p90_peak > r.n_minus_1_mw_winter AS needs_flex, actual_peak > r.n_minus_1_mw_winter AS actual_exceeds,
   r.n_minus_1_mw_winter - p90_peak AS margin_mw FROM ({PEAKS_SQL}) p JOIN ({LIMITS.replace('1.6D', '1.6::DOUBLE')}) r ON r.key = p.key"""


@check("daily_peaks", f"SELECT key, day, ROUND(actual_peak, 4) AS actual_peak, ROUND(forecast_peak, 4) AS forecast_peak, ROUND(p90_peak, 4) AS p90_peak FROM ({PEAKS_SQL}) p", digits=4)
def _(spark, sf):
    return cp.daily_peaks(frame(spark, sf, LOADS), ["key"])


def flex_days(spark, sf):
    return cp.flexibility_days(cp.daily_peaks(frame(spark, sf, LOADS), ["key"]), frame(spark, sf, LIMITS), ["key"])


@check("flexibility_days", f"SELECT key, day, ROUND(p90_peak, 5) AS p90_peak, needs_flex, actual_exceeds, ROUND(margin_mw, 5) AS margin_mw FROM ({DAYS_SQL}) d", digits=5)
def _(spark, sf):
    return flex_days(spark, sf).select("key", "day", "p90_peak", "needs_flex", "actual_exceeds", "margin_mw")


@check("worst_day", f"SELECT key, arg_min(day, margin_mw) AS day, ROUND(MIN(margin_mw), 2) AS margin_mw FROM ({DAYS_SQL}) d WHERE needs_flex GROUP BY 1", digits=2)
def _(spark, sf):
    return cp.worst_day(flex_days(spark, sf), ["key"])


@check(
    "monthly_need",
    f"""SELECT key, CAST(date_trunc('month', day) AS DATE) AS month, CAST(SUM(needs_flex::INT) AS BIGINT) AS days_needing_flex, CAST(SUM(actual_exceeds::INT) AS BIGINT) AS days_exceeding,
        ROUND(COALESCE(SUM(CASE WHEN margin_mw < 0 THEN -margin_mw END), 0.0), 2) AS total_shortfall_mw FROM ({DAYS_SQL}) d GROUP BY 1, 2""",
    digits=2,
)
def _(spark, sf):
    return cp.monthly_need(flex_days(spark, sf), ["key"])


ROOM = "SELECT c_custkey, CASE WHEN c_custkey % 6 = 0 THEN 'n/a' ELSE CAST(c_acctbal AS STRING) END AS headroom_mw FROM {customer}"


@check("positive_headroom", f"SELECT c_custkey, ROUND(TRY_CAST(headroom_mw AS DOUBLE), 4) AS headroom_mw FROM ({_sql(ROOM)}) r WHERE TRY_CAST(headroom_mw AS DOUBLE) > 0", digits=4)
def _(spark, sf):
    return cp.positive_headroom(frame(spark, sf, ROOM))


@check(
    "capacity_alerts",
    f"""WITH l AS (SELECT o_orderpriority AS key, MAX(o_totalprice) AS m, COUNT(DISTINCT o_orderstatus) AS s FROM {{orders}} GROUP BY 1)
        SELECT l.key, ROUND(m, 2) AS max_load, s AS source_names, ROUND(r.n_minus_1_mw_winter, 2) AS rating_mw, m > 1.2 * r.n_minus_1_mw_winter AS over_capacity,
               ROUND(m / r.n_minus_1_mw_winter, 2) AS load_to_rating, s > 1 AS mixed_sources FROM l LEFT JOIN ({LIMITS.replace('1.6D', '1.6::DOUBLE')}) r ON r.key = l.key""",
    digits=2,
)
def _(spark, sf):
    load = frame(spark, sf, "SELECT o_orderpriority AS key, o_totalprice AS value, o_orderstatus AS ltds_name FROM {orders}")
    return cp.capacity_alerts(load, frame(spark, sf, LIMITS), ["key"], factor=1.2)


@check("flexibility_days_one_rating", f"SELECT key, day, p90_peak > 200000 AS needs_flex FROM ({PEAKS_SQL}) p")
def _(spark, sf):
    one = frame(spark, sf, "SELECT MAX(o_totalprice) * 0.0D + 200000.0D AS n_minus_1_mw_winter FROM {orders}")
    return cp.flexibility_days(cp.daily_peaks(frame(spark, sf, LOADS), ["key"]), one).select("key", "day", F.col("needs_flex"))
