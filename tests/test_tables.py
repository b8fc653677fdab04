"""Query parameters, catalog, domain reads and files."""

from __future__ import annotations

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from gridspark.functions import scalars as sc
from gridspark.operators import query as qy
from gridspark.sources import catalog as ct
from gridspark.sources import io
from gridspark.sources.catalog import Catalog
from gridspark.sources.domain import READS, Domain


@pytest.fixture(scope="module")
def records(spark):
    rows = [("a", "North", 1.5), ("b", "South", 2.5), ("c", None, 3.5), ("d", "North", 0.5)]
    return spark.createDataFrame(rows, "record_id string, region string, consumption_kwh double")


def ids(df, column="record_id"):
    return [r[column] for r in df.collect()]


def test_parameters(records):
    assert ids(qy.query(records, order_by="-consumption_kwh", limit=2)) == ["c", "b"]
    assert ids(qy.query(records, order_by="consumption_kwh", offset=1, limit=2)) == ["a", "b"]
    assert ids(qy.query(records, exclude={"region": "North"}, order_by="record_id")) == ["b", "c"]
    assert ids(qy.query(records, refine={"region": "North"}, where="consumption_kwh > 1")) == ["a"]
    assert qy.query(records, columns=("record_id", "region")).columns == ["record_id", "region"]
    assert qy.query(records, select="record_id", order_by="-consumption_kwh").columns == ["record_id"]
    with pytest.raises(ValueError, match="give one of them"):
        qy.query(records, select="a", columns="b")
    out = qy.query(records, select="count(*) as n, sum(consumption_kwh) as s", group_by="region", order_by="region")
    assert out.columns == ["region", "n", "s"]
    assert qy.query(records, where=" () ").count() == 4


def test_user_condition_is_taken_as_a_whole(records):
    cond = qy.merge_where(F.col("region") == "North", "consumption_kwh > 9 OR record_id = 'd'")
    assert ids(records.where(cond)) == ["d"]


def test_total_and_facets(records):
    page = qy.with_total(qy.page(records, "record_id", 1), records).collect()
    assert [(r["record_id"], r["total_count"]) for r in page] == [("a", 4)]
    facets = {(r["facet"], r["value"]): r["count"] for r in qy.facet_counts(records, ["region"]).collect()}
    assert facets == {("region", "North"): 2, ("region", "South"): 1}


def test_catalog(spark, records):
    catalog = Catalog(spark)
    assert len(catalog.names()) == 118 and len(set(catalog.names().values())) == 97
    assert catalog.entries().select("group_name").distinct().count() == 18
    assert catalog.resolve("observed_peak_demand") == catalog.resolve("table_3a") == catalog.resolve("ltds/table_3a")
    with pytest.raises(ValueError, match="no table is named 'nope'; names are .*table_1"):
        catalog.resolve("nope")
    catalog.register("circuit_data", records)
    assert catalog.get("table_1", limit=2).count() == 2
    assert Catalog(spark, ids={"table_1": "published-id"}).resolve("circuit_data") == "published-id"
    listed = catalog.list_datasets(limit=5, where="group_name = 'ltds'")
    assert [r["alias"] for r in listed.collect()] == ["cim", "circuit_data", "connection_interest", "fault_data", "fault_level_3ph"]


def test_catalog_reads_files(spark, records, tmp_path):
    records.write.parquet(str(tmp_path / "dnoa" / "dnoa"))
    assert Catalog(spark, root=str(tmp_path)).read("dnoa").count() == 4


def test_drift_and_ids(spark):
    schema = "dataset_id string, fields array<string>"
    stored = spark.createDataFrame([("a", ["x", "y"]), ("b", ["p"]), ("gone", ["q"])], schema)
    live = spark.createDataFrame([("a", ["y", "z"]), ("b", ["p"]), ("new", ["q"])], schema)
    rows = ct.schema_drift(stored, live).collect()
    assert [(r["dataset_id"], r["added"], r["removed"], r["breaking"]) for r in rows] == [("a", ["z"], ["x"], True)]
    meta = spark.createDataFrame([(0, " a ", "First"), (1, "a", "Second"), (2, " ", "Blank"), (3, "c", None)], "row int, datasetid string, `default.title` string")
    published = ct.published_ids(meta)
    assert {(r["dataset_id"], r["title"]) for r in published.collect()} == {("a", "First"), ("c", "")}
    assert ids(ct.unmanaged_ids(published, stored), "dataset_id") == ["c"]
    assert ids(ct.merged_ids(published, stored), "dataset_id") == ["a", "b", "c", "gone"]


def test_licence_areas(spark):
    df = spark.createDataFrame([(" epn ",), ("South Eastern Power Networks",), ("x",), (None,)], "licencearea string")
    assert [r[0] for r in df.select(sc.expand_licence_area("licencearea")).collect()] == ["Eastern Power Networks (EPN)", "South Eastern Power Networks", "x", None]
    assert [r[0] for r in df.select(sc.detect_licence_area(df)).collect()] == ["EPN", "SPN", None, None]
    with pytest.raises(ValueError, match="is written 'LPN'"):
        sc.licence_area_code("London Power Networks (LPN)")
    assert sc.licence_area_code(" spn ") == "SPN" and sc.licence_area_value(None) is None


def test_scalars(spark):
    df = spark.createDataFrame([("11kV", "2024-03-01"), (" 33 ", "2024-03-01T10:00:00Z"), ("abc", "soon"), (None, None)], "v string, d string")
    assert [r[0] for r in df.select(sc.parse_voltage("v")).collect()] == [11.0, 33.0, None, None]
    assert [r[0] for r in df.select(sc.normalise_date("d")).collect()] == [date(2024, 3, 1)] * 2 + [None, None]
    assert sc.day_literal("2024-03-01T10:00:00Z") == date(2024, 3, 1) == sc.day_literal(datetime(2024, 3, 1, 5))
    with pytest.raises(ValueError):
        sc.day_literal("soon")
    nested = spark.sql("SELECT named_struct('a', array(1.0D, CAST('NaN' AS DOUBLE)), 'm', map('k', CAST('Infinity' AS DOUBLE))) AS s")
    assert sc.sanitise(nested).first()["s"].asDict() == {"a": [1.0, None], "m": {"k": None}}


def test_time_columns_and_numbers_are_inferred(spark):
    df = spark.createDataFrame([("2024-01-01", "1", "x")] * 9 + [("bad", "-", "2")], "start_date string, kw string, note string")
    out = dict(sc.infer_types(df).dtypes)
    assert out == {"start_date": "timestamp", "kw": "double", "note": "string"}


# --- domain reads -----------------------------------------------------------------------------


def test_quotes_in_values_are_harmless(spark):
    catalog = Catalog(spark)
    catalog.register("table_6", spark.createDataFrame([("O'Hare", 1)], "substation string, n int"))
    assert Domain(catalog).get_table_6(substation="O'Hare").count() == 1


def test_whole_end_day_is_an_option(spark):
    catalog = Catalog(spark)
    rows = [(datetime(2024, 3, 31), "a"), (datetime(2024, 3, 31, 15), "b")]
    catalog.register("dispatches", spark.createDataFrame(rows, "start_time_local timestamp_ntz, product string"))
    d = Domain(catalog)
    assert ids(d.get_dispatches(end_date="2024-03-31"), "product") == ["a"]
    assert d.get_dispatches(end_date="2024-03-31", end_inclusive_day=True).count() == 2


def test_routing_errors(spark):
    d = Domain(Catalog(spark))
    with pytest.raises(ValueError, match="one table per licence area.*33kv_half_hourly_epn, 33kv_half_hourly_spn"):
        d.get_circuit_timeseries("33kv", "half_hourly")
    with pytest.raises(ValueError, match="monthly rows only"):
        d.get_circuit_data("33kv", "half_hourly")
    with pytest.raises(ValueError, match="no table is named"):
        d.get_circuit_timeseries("33kv", "half_hourly", licence_area="LPN")
    assert set(READS) >= {"get_table_1", "get_events", "get_curtailment", "get_secondary_sites"}


def test_substation_pipeline(spark):
    catalog = Catalog(spark)
    a = [("South Eastern Power Networks (SPN)", "Alpha", "G", "n1", "33kV"), ("x", "Beta", "G", "n2", "11")]
    catalog.register("table_2a", spark.createDataFrame(a, "licencearea string, lv_substation string, hv_substation string, lv_node string, voltage_lv string"))
    b = "licencearea string, hv_substation string, lv_substation_1 string, lv_substation_2 string, lv_node_1 string, lv_node_2 string, voltage_lv_1 string, voltage_lv_2 string"
    catalog.register("table_2b", spark.createDataFrame([], b))
    monthly = [("t1", "Alpha", "SPN"), ("t2", "Beta", "SPN"), ("t3", "Alpha", "SPN")]
    m = spark.createDataFrame(monthly, "tx_id string, ltds_name string, licence_area string").withColumn("timestamp", F.lit(datetime(2024, 1, 1)))
    catalog.register("grid_monthly", m.where("tx_id <> 't3'"))
    catalog.register("primary_monthly", m.where("tx_id = 't3'"))
    series = [(datetime(2024, 1, d), t, 1.0 * d, "SPN") for d in (1, 2, 3) for t in ("t1", "t2", "t3")]
    s = spark.createDataFrame(series, "timestamp timestamp, tx_id string, active_power_mw double, licence_area string")
    catalog.register("grid_half_hourly", s.where("tx_id <> 't3'"))
    catalog.register("primary_half_hourly_spn", s.where("tx_id = 't3'").drop("licence_area"))
    catalog.register("primary_half_hourly_epn", s.where("false"))
    d = Domain(catalog)
    # Alpha's only side is 33 kV: grid ids only, so t3 stays out.
    out = d.get_half_hourly_timeseries("Alpha", start_date="2024-01-02")
    assert sorted((r["tx_id"], r["timestamp"].day) for r in out.collect()) == [("t1", 2), ("t1", 3)]
    assert d.get_half_hourly_timeseries("Nowhere", licence_area="SPN").count() == 0
    with pytest.raises(ValueError, match="tells its licence area"):
        d.get_half_hourly_timeseries("Beta")


# --- files ------------------------------------------------------------------------------------


def test_json_records(spark, tmp_path):
    lines = [
        {"id": 1, "fields": {"timestamp": "2024-01-01T00:00:00Z", "mw": 1.0}},
        {"recordid": "r2", "timestamp": "2024-01-01T00:30:00Z", "mw": 2.0},
        {"timestamp": "2024-01-01T01:00:00Z", "mw": 3.0},
    ]
    path = tmp_path / "r.json"
    path.write_text("\n".join(json.dumps(x) for x in lines))
    rows = io.read_records(spark, str(path)).orderBy("timestamp").collect()
    assert [(r["id"], r["mw"]) for r in rows] == [("1", 1.0), ("r2", 2.0), ("unknown", 3.0)]


def test_json_records_unwrap_features(spark, tmp_path):
    path = tmp_path / "r.json"
    path.write_text(json.dumps({"id": 1, "geo_shape": {"type": "Feature", "geometry": {"type": "Point", "coordinates": [1.0, 2.0]}}}))
    shape = io.read_records(spark, str(path)).first()["geo_shape"]
    assert json.loads(shape) == {"type": "Point", "coordinates": [1.0, 2.0]}


def test_export(spark, records, tmp_path):
    io.export(records, str(tmp_path / "c"), "csv", where="region = 'North'", order_by="record_id", limit=0)
    back = io.read_delimited(spark, str(tmp_path / "c"), "record_id string, region string, consumption_kwh double")
    assert ids(back.orderBy("record_id")) == ["a", "d"]
    for fmt in ("json", "parquet"):
        io.export(records, str(tmp_path / fmt), fmt, select="record_id", limit=3)
        assert spark.read.format(fmt).load(str(tmp_path / fmt)).count() == 3
    with pytest.raises(ValueError, match="cannot write 'kml'"):
        io.export(records, str(tmp_path / "k"), "kml")


def test_geojson_export(spark, tmp_path):
    rows = [("p", '{"type":"Point","coordinates":[1.0,2.0,3.0]}'), ("q", None)]
    df = spark.createDataFrame(rows, "name string, geo_shape string")
    io.export_geojson(df, str(tmp_path / "g"), "2d")
    found = sorted((json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "g")).collect()), key=lambda f: f["properties"]["name"])
    assert found[0] == {"type": "Feature", "geometry": {"type": "Point", "coordinates": [1.0, 2.0]}, "properties": {"name": "p"}}
    assert found[1]["geometry"] is None
    with pytest.raises(ValueError, match="are none of"):
        io.geojson_features(df, "4d")


def test_area_comes_from_rows_without_nodes(spark):
    """A substation whose rows tell its area but no node has no series, which is no error; end days may be whole."""
    catalog = Catalog(spark)
    columns = "licencearea string, lv_substation string, hv_substation string, lv_node string, voltage_lv string"
    catalog.register("table_2a", spark.createDataFrame([("South Eastern Power Networks (SPN)", "Gamma", "G", "", None)], columns))
    b = "licencearea string, hv_substation string, lv_substation_1 string, lv_substation_2 string, lv_node_1 string, lv_node_2 string, voltage_lv_1 string, voltage_lv_2 string"
    catalog.register("table_2b", spark.createDataFrame([], b))
    rows = spark.createDataFrame([("t1", "Alpha", "SPN", datetime(2024, 1, 1, h)) for h in (0, 12)], "tx_id string, ltds_name string, licence_area string, timestamp timestamp")
    for name in ("grid_monthly", "primary_monthly", "grid_half_hourly", "primary_half_hourly_spn", "primary_half_hourly_epn"):
        catalog.register(name, rows)
    d = Domain(catalog)
    assert d.substation_area("Gamma") == "SPN"
    assert d.get_half_hourly_timeseries("Gamma").count() == 0
    assert d.get_transformer_timeseries("grid", end_date="2024-01-01").count() == 1
    assert d.get_transformer_timeseries("grid", end_date="2024-01-01", end_inclusive_day=True).count() == 2
