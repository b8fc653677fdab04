"""Geometry, model XML and fitted forecasts."""

from __future__ import annotations

import json
from datetime import timedelta

import numpy as np
import pytest
from conftest import START
from pyspark.sql import functions as F

from gridspark.functions import geo
from gridspark.operators import features as ft
from gridspark.operators import forecast as fc
from gridspark.operators import network as nw
from gridspark.operators.query import query
from gridspark.operators.spatial import query_bounds
from gridspark.sources.catalog import Catalog

POINT = '{"type":"Point","coordinates":[-0.1,51.5]}'


def shape_frame(spark, rows):
    return spark.createDataFrame(rows, "name string, geo_shape string, geo_point_2d string")


def test_geometry_priority(spark):
    df = shape_frame(
        spark,
        [
            ("first", POINT, '{"lat":1,"lon":2}'),
            ("feature", '{"type":"Feature","geometry":' + POINT + "}", None),
            ("second", None, '{"lat":1.0,"lon":2.0}'),
            ("skipped", '{"foo":1}', POINT),
            ("none", None, None),
        ],
    )
    got = {r["name"]: r["g"] and json.loads(r["g"]) for r in df.select("name", geo.resolve_geometry(df).alias("g")).collect()}
    point = json.loads(POINT)
    assert got == {"first": point, "feature": point, "second": {"type": "Point", "coordinates": [2.0, 1.0]}, "skipped": point, "none": None}


def test_z_for_every_type(spark):
    shapes = {
        "Point": [1.0, 2.0, 9.0],
        "LineString": [[1.0, 2.0], [3.0, 4.0, 9.0]],
        "Polygon": [[[0.0, 0.0, 1.0], [1.0, 0.0, 1.0], [0.0, 0.0, 1.0]]],
        "MultiPolygon": [[[[0.0, 0.0], [1.0, 0.0], [0.0, 0.0]]]],
    }
    df = shape_frame(spark, [(k, json.dumps({"type": k, "coordinates": c}), None) for k, c in shapes.items()])
    out = {r["name"]: (json.loads(r["a"])["coordinates"], json.loads(r["b"])["coordinates"]) for r in df.select("name", geo.strip_z(F.col("geo_shape")).alias("a"), geo.ensure_z(F.col("geo_shape")).alias("b")).collect()}
    assert out["Point"] == ([1.0, 2.0], [1.0, 2.0, 9.0])
    assert out["LineString"] == ([[1.0, 2.0], [3.0, 4.0]], [[1.0, 2.0, 0.0], [3.0, 4.0, 9.0]])
    assert out["Polygon"][0] == [[[0.0, 0.0], [1.0, 0.0], [0.0, 0.0]]]
    assert out["MultiPolygon"][1] == [[[[0.0, 0.0, 0.0], [1.0, 0.0, 0.0], [0.0, 0.0, 0.0]]]]


BOUNDS = {"north": 51.7, "south": 51.3, "east": 0.2, "west": -0.5}


def square(x, y, h):
    return json.dumps({"type": "Polygon", "coordinates": [[[x - h, y - h], [x - h, y + h], [x + h, y + h], [x + h, y - h], [x - h, y - h]]]})


def test_areas_and_lines_meet_bounds(spark):
    line = json.dumps({"type": "LineString", "coordinates": [[-2.0, 51.5], [2.0, 51.5]]})
    away = json.dumps({"type": "LineString", "coordinates": [[-2.0, 53.5], [2.0, 53.5]]})
    rows = [("inside", square(0, 51.5, 0.01)), ("edge", square(0.2, 51.5, 0.05)), ("around", square(0, 51.5, 5)), ("far", square(5, 55, 0.1)), ("through", line), ("away", away), ("broken", "x")]
    df = shape_frame(spark, [(n, g, None) for n, g in rows])
    found = {r["name"] for r in query(df, polygon=geo.bounds_ring(**BOUNDS)).collect()}
    assert found == {"inside", "edge", "around", "through"}
    as_text = ",".join(f"({x},{y})" for x, y in geo.bounds_ring(**BOUNDS))
    assert query(df, polygon=as_text).count() == 4
    assert as_text.startswith("(-0.5,51.3),(-0.5,51.7)")


def test_distance(spark):
    df = spark.createDataFrame([("near", -0.1, 51.5), ("far", 1.0, 52.0)], "name string, lon double, lat double")
    assert [r["name"] for r in query(df, distance=(-0.12, 51.51, 5000)).collect()] == ["near"]
    pole = spark.createDataFrame([("other side", 180.0, 89.99)], "name string, lon double, lat double")
    assert query(pole, distance=(0.0, 89.99, 3000)).count() == 1


def test_bounds_over_tables(spark, tmp_path):
    catalog = Catalog(spark)
    catalog.register("secondary_sites", spark.createDataFrame([("a", 0.0, 51.5), ("b", 9.0, 51.5)], "name string, lon double, lat double"))
    catalog.register("lv_poles", str(tmp_path / "missing"))
    found = query_bounds(catalog, BOUNDS, ["secondary_sites", "lv_poles"])
    assert [(r["dataset"], r["name"]) for r in found.union().collect()] == [("secondary_sites", "a")]
    assert list(found.errors) == ["lv_poles"] and found.status().first()["rows"] == 1
    with pytest.raises(ValueError, match="no tables are named"):
        query_bounds(catalog, BOUNDS, ["nope"])


# --- model XML --------------------------------------------------------------------------------

XML = """<?xml version="1.0" encoding="UTF-8"?>
<rdf:RDF xmlns:cim="http://iec.ch/TC57/CIM100#" xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#">
  <cim:BaseVoltage rdf:ID="_bv1"><cim:BaseVoltage.nominalVoltage>33</cim:BaseVoltage.nominalVoltage></cim:BaseVoltage>
  <cim:Substation rdf:ID="_s1"><cim:IdentifiedObject.name>Alpha</cim:IdentifiedObject.name></cim:Substation>
  <cim:VoltageLevel rdf:ID="_v1"><cim:VoltageLevel.Substation rdf:resource="#_s1"/><cim:VoltageLevel.BaseVoltage rdf:resource="#_bv1"/></cim:VoltageLevel>
  <cim:PowerTransformer rdf:ID="_t1"><cim:IdentifiedObject.name>T1</cim:IdentifiedObject.name><cim:Equipment.EquipmentContainer rdf:resource="#_v1"/></cim:PowerTransformer>
  <cim:PowerTransformer rdf:ID="_t2"><cim:IdentifiedObject.name>T2</cim:IdentifiedObject.name></cim:PowerTransformer>
  <cim:PowerTransformerEnd rdf:ID="_e1"><cim:PowerTransformerEnd.PowerTransformer rdf:resource="#_t1"/><cim:TransformerEnd.endNumber>1</cim:TransformerEnd.endNumber><cim:PowerTransformerEnd.ratedS>24</cim:PowerTransformerEnd.ratedS><cim:PowerTransformerEnd.ratedU>33</cim:PowerTransformerEnd.ratedU><cim:PowerTransformerEnd.r>0.5</cim:PowerTransformerEnd.r><cim:PowerTransformerEnd.x>9.1</cim:PowerTransformerEnd.x><cim:TransformerEnd.BaseVoltage rdf:resource="#_bv1"/></cim:PowerTransformerEnd>
  <cim:PowerTransformerEnd rdf:ID="_e2"><cim:PowerTransformerEnd.PowerTransformer rdf:resource="#_t1"/><cim:TransformerEnd.endNumber>2</cim:TransformerEnd.endNumber><cim:PowerTransformerEnd.ratedU>11</cim:PowerTransformerEnd.ratedU></cim:PowerTransformerEnd>
  <cim:PowerTransformerEnd rdf:ID="_e3"><cim:PowerTransformerEnd.PowerTransformer rdf:resource="#_t2"/><cim:TransformerEnd.endNumber>1</cim:TransformerEnd.endNumber></cim:PowerTransformerEnd>
  <cim:PhotoVoltaicUnit rdf:ID="_p1"><cim:IdentifiedObject.name>PV</cim:IdentifiedObject.name><cim:PowerElectronicsUnit.maxP>4.5</cim:PowerElectronicsUnit.maxP></cim:PhotoVoltaicUnit>
  <cim:PhotoVoltaicUnit rdf:ID="_p2"><cim:IdentifiedObject.name>PV2</cim:IdentifiedObject.name></cim:PhotoVoltaicUnit>
</rdf:RDF>
"""


def test_model_xml(spark, tmp_path):
    path = str(tmp_path / "model.xml")
    (tmp_path / "model.xml").write_text(XML)
    t = {c: nw.read_xml_class(spark, path, c) for c in ("BaseVoltage", "Substation", "VoltageLevel", "PowerTransformer", "PowerTransformerEnd", "PhotoVoltaicUnit")}
    assert t["BaseVoltage"].first().asDict() == {"id": "bv1", "base_kv": 33.0}
    assert [r["name"] for r in t["PowerTransformer"].orderBy("id").collect()] == ["T1", "T2"]
    ends = nw.transformer_ends(t["PowerTransformer"], t["PowerTransformerEnd"], t["BaseVoltage"], nw.container_names(t["Substation"], t["VoltageLevel"]))
    assert {(r["name"], r["substation"], r["base_kv"]) for r in ends.collect()} == {("T1", "Alpha", 33.0), ("T1", "Alpha", None), ("T2", "Unknown", None)}
    good = nw.percent_impedance(nw.usable_transformers(ends)).collect()
    assert [(r["transformer_id"], r["hv_kv"], r["lv_kv"]) for r in good] == [("t1", 33.0, 11.0)]
    assert good[0]["vkx_percent"] == pytest.approx(9.1 / (33**2 / 24) * 100)
    counts = {r["class"]: r["count"] for r in nw.element_counts(spark, path).collect()}
    assert counts["PowerTransformerEnd"] == 3 and counts["PhotoVoltaicUnit"] == 2 and sum(counts.values()) == 10
    totals = nw.capacity_totals({"PhotoVoltaicUnit": t["PhotoVoltaicUnit"]}).first()
    assert (totals["units"], totals["total_mw"]) == (2, 4.5)


def test_model_xml_in_one_read(spark, tmp_path):
    path = str(tmp_path / "model.xml")
    (tmp_path / "model.xml").write_text(XML)
    classes = ("BaseVoltage", "Substation", "VoltageLevel", "PowerTransformer", "PowerTransformerEnd", "PhotoVoltaicUnit", "BatteryUnit")
    for name, df in nw.read_model(spark, path, classes).items():
        assert df.columns == nw.read_xml_class(spark, path, name).columns
        assert sorted(map(str, df.collect())) == sorted(map(str, nw.read_xml_class(spark, path, name).collect())), name
    counts = {r["class"]: r["count"] for r in nw.model_counts(nw.shred_model(spark, path)).collect()}
    assert counts["PowerTransformerEnd"] == 3 and sum(counts.values()) == 10


def test_model_xml_is_cut_anywhere(spark, tmp_path):
    """Splits of a few bytes: properties far from their element, splits without any element."""
    items = [f'  <cim:BatteryUnit rdf:ID="_b{i}">\n <cim:IdentifiedObject.name>{"long name " * (i % 9)}{i} &lt;&amp;&gt;</cim:IdentifiedObject.name>\n\t<cim:PowerElectronicsUnit.maxP>{i}.5</cim:PowerElectronicsUnit.maxP>\n<cim:BatteryUnit.ratedE>{i}</cim:BatteryUnit.ratedE></cim:BatteryUnit>\n' for i in range(120)]
    (tmp_path / "model.xml").write_text('<?xml version="1.0"?>\n<rdf:RDF xmlns:cim="x#" xmlns:rdf="y#">\n' + "".join(items) + "</rdf:RDF>\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "97")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        model = nw.shred_model(spark, str(tmp_path / "model.xml"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])
    got = {r["id"]: tuple(r)[1:] for r in nw.model_class(model, "BatteryUnit").collect()}
    assert got == {f"b{i}": (f"{'long name ' * (i % 9)}{i} <&>", i + 0.5, float(i)) for i in range(120)}


def test_supply_and_loads(spark):
    units = spark.createDataFrame([("G", "A", 132.0, 33.0, 60.0, 0.3, 12.0), ("A", "B", 33.0, 11.0, 24.0, 0.5, 20.0)], "hv_substation string, lv_substation string, voltage_hv double, voltage_lv double, transformer_rating_mva_winter double, positive_sequence_impedance_r_percent double, positive_sequence_impedance_x_percent double")
    nodes = nw.node_table(units)
    assert {(r["node"], r["vn_kv"]) for r in nodes.collect()} == {("G", 132.0), ("A", 33.0), ("B", 11.0)}
    assert nw.supply_node(nodes).first()["node"] == "G"
    demand = spark.createDataFrame([("B", "8.0", None), ("Z", "1.0", 0.9), ("A", None, 0.9)], "substation string, maximum_demand_24_25_mw string, maximum_demand_24_25_pf double")
    load = nw.load_table(demand, nodes).collect()
    assert len(load) == 1 and load[0]["q_mvar"] == pytest.approx(8.0 * np.tan(np.arccos(0.95)))


# --- fitted models ----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def load(make):
    rng = np.random.default_rng(1)
    values = [100 + 20 * np.sin(2 * np.pi * i / 48) + rng.normal() for i in range(48 * 30)]
    return make(values).withColumnRenamed("value", "load_mw").persist()


def test_models_beat_the_mean(load):
    rows = ft.calendar_features(ft.load_features(load, value="load_mw").dropna()).persist()
    train, test = ft.time_split(rows, "2024-01-24", "2024-01-25")
    features = ["hour_sin", "hour_cos", "load_lag_1", "load_lag_48", "load_rolling_mean_4h"]
    makers = (fc.linear_pipeline(features), fc.forest_pipeline(features, trees=5, depth=5), fc.boosting_pipeline(features, rounds=5, depth=3))
    for maker in makers:
        model = maker.fit(train)
        scored = fc.predict(model, test).withColumn("actual", F.col("load_mw"))
        r2 = fc.forecast_metrics(scored).first()["r2"]
        assert r2 > 0.9
    importances = fc.feature_importances(model, features, train)
    assert importances.count() == 5 and importances.agg(F.sum("importance")).first()[0] == pytest.approx(1.0)
    bands = fc.residual_bands(fc.predict(model, train), fc.predict(model, test))
    assert bands.where("p10 <= p50 AND p50 <= p90").count() == bands.count() > 0
    coverage = fc.interval_coverage(bands, "load_mw").first()["coverage"]
    assert 0.5 < coverage <= 1.0


def test_horizons(load):
    out = fc.evaluate_horizons(load, "2024-01-24", "2024-01-25", horizons={"1hr": 2, "24hr": 48}, make=fc.linear_pipeline, model_name="Linear")
    rows = {(r["horizon"], r["model"]): r for r in out.collect()}
    assert set(rows) == {(h, m) for h in ("1hr", "24hr") for m in ("Persistence", "Linear")}
    assert rows[("1hr", "Linear")]["rmse"] < rows[("1hr", "Persistence")]["rmse"]
    few = fc.evaluate_horizons(load, "2024-01-02", "2024-01-25", horizons={"1hr": 2}, make=fc.linear_pipeline, model_name="Linear").collect()
    few = {r["model"]: r for r in few}
    assert few["Persistence"]["rmse"] is not None and few["Linear"]["rmse"] is None and few["Linear"]["train_rows"] < fc.MIN_TRAIN


def test_horizon_targets(make):
    df = make(range(100)).withColumnRenamed("value", "load_mw")
    r = fc.horizon_frame(df, 12).where(F.col("load_mw") == 60).first()
    assert (r["target"], r["persist"], r["target_ts"]) == (71.0, 23.0, START + timedelta(minutes=30 * 71))


def test_metrics(spark):
    df = spark.createDataFrame([(10.0, 12.0), (20.0, 18.0), (0.0, 1.0)], "actual double, forecast double")
    r = fc.forecast_metrics(df).first()
    assert r["mae"] == pytest.approx(5 / 3) and r["rmse"] == pytest.approx(np.sqrt(3)) and r["mape"] == pytest.approx(15.0)
    assert r["r2"] == pytest.approx(1 - 9 / 200)


def ring_of(points, radius=1.0):
    import math

    return [(radius * math.cos(2 * math.pi * i / points), radius * math.sin(2 * math.pi * i / points)) for i in range(points)]


def test_distance_takes_every_geometry(spark):
    shapes = [
        ("point", '{"type":"Point","coordinates":[0,51.5]}'),
        ("line", '{"type":"LineString","coordinates":[[-1,51.5],[1,51.5]]}'),
        ("around", '{"type":"Polygon","coordinates":[[[-1,51],[1,51],[1,52],[-1,52],[-1,51]]]}'),
        ("hole", '{"type":"Polygon","coordinates":[[[-1,51],[1,51],[1,52],[-1,52],[-1,51]],[[-0.5,51.3],[0.5,51.3],[0.5,51.7],[-0.5,51.7],[-0.5,51.3]]]}'),
        ("far", '{"type":"MultiLineString","coordinates":[[[2,51.5],[3,51.5]],[[0,54],[0,55]]]}'),
        ("broken", "{"),
        ("none", None),
    ]
    df = spark.createDataFrame(shapes, "name string, geo_shape string")
    near = {r["name"] for r in df.where(geo.within_distance(df, "0,51.5,2000")).collect()}
    assert near == {"point", "line", "around"}


def test_large_ring_over_shapes(spark):
    shapes = [
        ("inside", '{"type":"Point","coordinates":[0.5,0.5]}'),
        ("corner", '{"type":"Point","coordinates":[0.9,0.9]}'),
        ("across", '{"type":"LineString","coordinates":[[-2,0.1],[2,0.1]]}'),
        ("beside", '{"type":"LineString","coordinates":[[-2,1.1],[2,1.1]]}'),
        ("around", '{"type":"Polygon","coordinates":[[[-3,-3],[3,-3],[3,3],[-3,3],[-3,-3]]]}'),
    ]
    df = spark.createDataFrame(shapes, "name string, geo_shape string")
    met = {r["name"] for r in df.where(geo.within_polygon(df, ring_of(2000))).collect()}
    assert met == {"inside", "across", "around"}
