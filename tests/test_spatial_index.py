"""Cell covers, pruned scans and tables that fail while they are read."""

from __future__ import annotations

import glob
import json
import math
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from gridspark.functions import cells, geo
from gridspark.operators.query import query
from gridspark.operators.spatial import fetch_bounds, report
from gridspark.sources.catalog import Catalog
from gridspark.sources.spatial_index import with_cells, write_indexed


def shapes(n, rng):
    out = []
    for i in range(n):
        x, y = rng.uniform(-179, 179), rng.uniform(-89, 89)
        size = rng.choice([0.001, 0.1, 5, 60])
        x2, y2 = min(180, x + size), min(90, y + size / 2)
        kind = i % 4
        if kind == 0:
            g = {"type": "Point", "coordinates": [x, y]}
        elif kind == 1:
            g = {"type": "LineString", "coordinates": [[x, y], [x2, y2]]}
        elif kind == 2:
            g = {"type": "Polygon", "coordinates": [[[x, y], [x, y2], [x2, y2], [x2, y], [x, y]]]}
        else:
            g = {"type": "GeometryCollection", "geometries": [{"type": "Point", "coordinates": [x, y]}, {"type": "LineString", "coordinates": [[x, y], [x2, y2]]}]}
        out.append((i, json.dumps(g)))
    return [*out, (n, None), (n + 1, "broken"), (n + 2, '{"type":"Point","coordinates":[180,90]}'), (n + 3, '{"type":"Point","coordinates":[-180,-90]}')]


@pytest.fixture(scope="module")
def world(spark):
    return spark.createDataFrame(shapes(1200, random.Random(1)), "id long, geo_shape string")


@pytest.fixture(scope="module")
def stored(spark, world, tmp_path_factory):
    path = f"{tmp_path_factory.mktemp('index')}/t"
    write_indexed(world, path, rows_per_file=400, row_group_bytes=1 << 20)
    return spark.read.parquet(path)


def test_a_row_has_the_smallest_cell_that_holds_its_box(world):
    for r in with_cells(world).where("_z is not null").collect():
        shift = 2 * (cells.LEVELS - r["_level"])
        assert r["_z_end"] - r["_z"] == (1 << shift) - 1 and r["_z"] % (1 << shift) == 0
        west, east, south, north = cells._cell_box(r["_level"], r["_z"] >> shift)
        assert west <= r["_west"] <= r["_east"] <= east and south <= r["_south"] <= r["_north"] <= north
        if r["_level"] < cells.LEVELS:
            inner = [cells._cell_box(r["_level"] + 1, 4 * (r["_z"] >> shift) + k) for k in range(4)]
            assert not any(w <= r["_west"] and r["_east"] < e and s <= r["_south"] and r["_north"] < n for w, e, s, n in inner)


def ring_around(x, y, r, points=40):
    return [(x + r * (1 + 0.4 * math.sin(7 * a)) * math.cos(a), y + r * math.sin(a) / 2) for a in (2 * math.pi * k / points for k in range(points))]


@pytest.mark.parametrize("ring", [ring_around(10, 20, 15), ring_around(-100, -40, 0.5), ring_around(0, 0, 90), [(-180, -90), (-180, 90), (180, 90), (180, -90)], ring_around(170, 80, 30)])
def test_index_changes_no_result(world, stored, ring):
    want = sorted(r["id"] for r in query(world, polygon=ring).collect())
    found = query(stored, polygon=ring)
    assert found.columns == ["id", "geo_shape"]
    assert sorted(r["id"] for r in found.collect()) == want
    x, y = ring[0][0], max(-80.0, min(80.0, ring[0][1]))
    near = (max(-170.0, min(170.0, x)), y, 900_000.0)
    assert sorted(r["id"] for r in query(stored, distance=near).collect()) == sorted(r["id"] for r in query(world, distance=near).collect())


def test_ranges_cover_the_ring():
    rng = random.Random(3)
    ring = ring_around(12.3, 45.6, 4)
    ranges = cells.ring_ranges(ring)
    assert len(ranges) <= cells.MAX_CELLS + 4 and all(a[1] + 1 < b[0] for a, b in zip(ranges, ranges[1:]))
    side = 1 << cells.LEVELS
    for _ in range(3000):
        k = rng.randrange(len(ring))
        t, u = rng.random(), rng.random()
        (x1, y1), (x2, y2) = ring[k], ring[(k + 1) % len(ring)]
        x, y = 12.3 + u * (x1 + t * (x2 - x1) - 12.3), 45.6 + u * (y1 + t * (y2 - y1) - 45.6)
        ix, iy = int((x + 180) / 360 * side), int((y + 90) / 180 * side)
        z = sum((ix >> b & 1) << 2 * b | (iy >> b & 1) << 2 * b + 1 for b in range(cells.LEVELS))
        assert any(low <= z <= high for low, high in ranges)


def test_a_small_ring_reads_few_row_groups(spark, tmp_path):
    n = 200_000
    df = spark.range(n).select("id", (F.rand(1) * 340 - 170).alias("lon"), (F.rand(2) * 160 - 80).alias("lat"), F.rand(3).alias("pad"))
    path = f"{tmp_path}/points"
    write_indexed(df, path, rows_per_file=20_000, row_group_bytes=64 << 10)
    ring = [(10.0, 40.0), (10.0, 44.0), (15.0, 44.0), (15.0, 40.0)]
    found = query(spark.read.parquet(path), select="id", polygon=ring)
    plan = found._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    pushed = next(line for line in plan.splitlines() if "PushedFilters" in line)
    assert "_west" in pushed and "_z_end" in pushed
    ranges, groups, read = cells.ring_ranges(ring), 0, 0
    for file in glob.glob(f"{path}/*.parquet"):
        meta = pq.read_metadata(file)
        place = {meta.schema.column(i).name: i for i in range(meta.num_columns)}
        for g in range(meta.num_row_groups):
            stats = {c: meta.row_group(g).column(place[c]).statistics for c in cells.INDEX_COLUMNS}
            box = stats["_west"].min <= 15 and stats["_east"].max >= 10 and stats["_south"].min <= 44 and stats["_north"].max >= 40
            groups += 1
            read += box and any(stats["_z"].min <= high and stats["_z_end"].max >= low for low, high in ranges)
    assert groups >= 40 and read < groups / 10
    want = spark.createDataFrame(df.collect(), df.schema).where("lon between 10 and 15 and lat between 40 and 44").count()
    assert abs(found.count() - want) == 0


def test_a_crowded_place_is_spread_over_files(spark, tmp_path):
    df = spark.range(9000).select("id", F.lit(1.0).alias("lon"), F.lit(2.0).alias("lat"))
    write_indexed(df, f"{tmp_path}/t", rows_per_file=1000)
    sizes = [pq.read_metadata(f).num_rows for f in glob.glob(f"{tmp_path}/t/*.parquet")]
    assert len(sizes) == 9 and max(sizes) < 2500 and sum(sizes) == 9000
    with pytest.raises(ValueError):
        write_indexed(spark.read.parquet(f"{tmp_path}/t"), f"{tmp_path}/u")


def test_a_damaged_file_leaves_the_other_tables_alone(spark, tmp_path):
    rows = spark.range(0, 4000, 1, 4).select("id", (F.col("id") / 4000).alias("lon"), F.lit(51.5).alias("lat"))
    catalog = Catalog(spark)
    for name in ("secondary_sites", "lv_poles", "grid_primary_sites"):
        rows.write.parquet(f"{tmp_path}/{name}")
        catalog.register(name, spark.read.parquet(f"{tmp_path}/{name}"))
    catalog.register("hv_poles", f"{tmp_path}/missing")
    damaged = sorted(glob.glob(f"{tmp_path}/lv_poles/*.parquet"))[1]
    with open(damaged, "rb") as f:
        start = f.read(200)
    with open(damaged, "wb") as f:
        f.write(start)
    for crc in glob.glob(f"{tmp_path}/lv_poles/.*.crc"):
        with open(crc, "wb"):
            pass
    found = fetch_bounds(catalog, {"north": 52, "south": 51, "east": 0.5, "west": 0.25}, ["secondary_sites", "lv_poles", "grid_primary_sites", "hv_poles"], store=f"{tmp_path}/out")
    assert set(found.results) == {"secondary_sites", "grid_primary_sites"} and set(found.errors) == {"lv_poles", "hv_poles"}
    assert found.results["secondary_sites"].count() == found.rows["secondary_sites"] > 900
    assert {(r["dataset"], r["rows"], r["error"] is None) for r in report(found, spark).collect()} == {("secondary_sites", found.rows["secondary_sites"], True), ("grid_primary_sites", found.rows["grid_primary_sites"], True), ("lv_poles", None, False), ("hv_poles", None, False)}
    assert found.status().count() == 2
