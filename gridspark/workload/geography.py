"""Geometry over customer locations made by arithmetic on their keys."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from gridspark.functions import geo
from gridspark.operators.query import query
from gridspark.operators.spatial import fetch_bounds, query_bounds, report
from gridspark.sources.catalog import Catalog
from gridspark.sources.io import geojson_features
from gridspark.sources.spatial_index import write_indexed
from gridspark.sources.staging import new_path, spread
from gridspark.workload.base import check, frame, table

LON = "ROUND(-2 + (c_custkey * 7919 % 4000) / 1000.0D, 3)"
LAT = "ROUND(50 + (c_custkey * 104729 % 3000) / 1000.0D, 3)"
SITES = f"SELECT c_custkey, {LON} AS lon, {LAT} AS lat FROM {{customer}}"
_XY = f"CAST({LON} AS STRING) || ',' || CAST({LAT} AS STRING)"
_POINT = f"""'{{"type":"Point","coordinates":[' || {_XY} || ']}}'"""
# Plain points, Feature-wrapped ones, lat/lon objects, unusable values, and a second field to fall back on.
SHAPES_SPARK = f"""SELECT c_custkey,
   CASE WHEN c_custkey % 11 = 0 THEN 'broken' WHEN c_custkey % 7 = 0 THEN '{{"lon":' || CAST({LON} AS STRING) || ',"lat":' || CAST({LAT} AS STRING) || '}}'
        WHEN c_custkey % 5 = 0 THEN '{{"type":"Feature","geometry":' || {_POINT} || ',"properties":{{}}}}' WHEN c_custkey % 3 = 0 THEN NULL ELSE {_POINT} END AS geo_shape,
   CASE WHEN c_custkey % 2 = 0 THEN {_POINT} END AS geo_point_2d FROM {{customer}}"""
SITES_SQL = SITES.replace("1000.0D", "1000.0::DOUBLE")


def shapes(spark, sf):
    # The JSON text has braces of its own, which the SQL formatter needs doubled.
    head, tail = SHAPES_SPARK.split("{customer}")
    text = f"{_doubled(head)}{{customer}}{_doubled(tail)}"
    return spark.sql(text, customer=table(spark, sf, "customer"))


def _doubled(text: str) -> str:
    return text.replace("{", "{{").replace("}", "}}")


RESOLVED = f"""SELECT c_custkey, CASE WHEN c_custkey % 11 = 0 OR (c_custkey % 7 <> 0 AND c_custkey % 5 <> 0 AND c_custkey % 3 = 0)
    THEN CASE WHEN c_custkey % 2 = 0 THEN true END ELSE true END AS ok, lon, lat FROM ({SITES_SQL}) s"""


@check("resolve_geometry", f"SELECT c_custkey, CASE WHEN ok THEN lon END AS lon, CASE WHEN ok THEN lat END AS lat FROM ({RESOLVED}) x", digits=3)
def _(spark, sf):
    rows = shapes(spark, sf)
    g = geo.resolve_geometry(rows)
    return rows.select("c_custkey", geo.point_lon(g).alias("lon"), geo.point_lat(g).alias("lat"))


@check(
    "unwrap_features",
    f"SELECT c_custkey, c_custkey % 11 <> 0 AND c_custkey % 7 <> 0 AND (c_custkey % 5 = 0 OR c_custkey % 3 <> 0) AS is_point FROM ({SITES_SQL}) x",
)
def _(spark, sf):
    out = geo.unwrap_features(shapes(spark, sf))
    return out.select("c_custkey", F.coalesce(F.get_json_object("geo_shape", "$.type") == "Point", F.lit(False)).alias("is_point"))


# A concave ring: the notch must be left out.
RING = [(-1.5, 50.5), (-1.5, 52.5), (0.25, 51.25), (1.5, 52.5), (1.5, 50.5), (-1.5, 50.5)]


def _ray_sql(lon: str, lat: str) -> str:
    parts = []
    for (x1, y1), (x2, y2) in zip(RING, RING[1:]):
        if y1 != y2:
            parts.append(f"CASE WHEN ({lat} < {y1}) <> ({lat} < {y2}) AND {lon} < ({lat} - {y1}) * ({x2 - x1}) / ({y2 - y1}) + {x1} THEN 1 ELSE 0 END")
    return f"({' + '.join(parts)}) % 2 = 1"


@check("polygon_filter", f"SELECT c_custkey FROM ({SITES_SQL}) s WHERE {_ray_sql('lon', 'lat')}")
def _(spark, sf):
    return query(frame(spark, sf, SITES), select="c_custkey", polygon=RING)


@check("polygon_filter_geojson", f"SELECT c_custkey FROM ({RESOLVED}) s WHERE ok AND {_ray_sql('lon', 'lat')}")
def _(spark, sf):
    return query(shapes(spark, sf), select="c_custkey", polygon=RING)


HAVERSINE = f"""2 * {geo.EARTH_RADIUS} * asin(sqrt(power(sin(radians(51.5 - lat) / 2), 2)
   + cos(radians(lat)) * cos(radians(51.5)) * power(sin(radians(0.1 - lon) / 2), 2)))"""


@check("distance_filter", f"SELECT c_custkey FROM ({SITES_SQL}) s WHERE {HAVERSINE} <= 60000")
def _(spark, sf):
    return query(frame(spark, sf, SITES), select="c_custkey", distance="0.1,51.5,60000")


def _near_sql(lon: str, lat: str) -> str:
    return f"{HAVERSINE.replace('51.5 - lat', f'51.5 - ({lat})').replace('radians(lat)', f'radians({lat})').replace('0.1 - lon', f'0.1 - ({lon})')} <= 60000"


# Lines of some 30 km: the share of a line that comes nearest, on a plane around the point.
_ALONG = "(0.1 - lon) * 0.3 * power(cos(radians(51.5)), 2) + (51.5 - lat) * 0.2"
_SHARE = f"greatest(0, least(1, ({_ALONG}) / (0.09 * power(cos(radians(51.5)), 2) + 0.04)))"


@check(
    "distance_filter_lines",
    f"SELECT c_custkey FROM (SELECT *, {_SHARE} AS share FROM ({SITES_SQL}) s) t WHERE {_near_sql('lon + 0.3 * share', 'lat + 0.2 * share')}",
)
def _(spark, sf):
    ends = F.array(F.array("lon", "lat"), F.array(F.col("lon") + 0.3, F.col("lat") + 0.2))
    shape = F.to_json(F.struct(F.lit("LineString").alias("type"), ends.alias("coordinates")))
    rows = frame(spark, sf, SITES).select("c_custkey", shape.alias("geo_shape"))
    return query(rows, select="c_custkey", distance="0.1,51.5,60000")


@check("great_circle_distance", f"SELECT c_custkey, ROUND({HAVERSINE}, 3) AS metres FROM ({SITES_SQL}) s", digits=3)
def _(spark, sf):
    metres = geo.great_circle_metres(F.col("lon"), F.col("lat"), F.lit(0.1), F.lit(51.5))
    return frame(spark, sf, SITES).select("c_custkey", metres.alias("metres"))


# Short lines and squares around each site; a square touches the bounds when its centre is near enough.
BOUNDS = {"north": 51.7, "south": 51.3, "east": 0.2, "west": -0.5}


def areas(spark, sf):
    def corner(dx, dy):
        return F.array(F.col("lon") + F.lit(dx), F.col("lat") + F.lit(dy))

    h = 0.0505
    ring = F.array(corner(-h, -h), corner(-h, h), corner(h, h), corner(h, -h), corner(-h, -h))
    shape = F.to_json(F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")))
    # Keys are dealt out, since texts are long.
    return spread(frame(spark, sf, SITES)).select("c_custkey", shape.alias("geo_shape"))


@check(
    "polygon_filter_areas",
    f"SELECT c_custkey FROM ({SITES_SQL}) s WHERE lon + 0.0505 >= -0.5 AND lon - 0.0505 <= 0.2 AND lat + 0.0505 >= 51.3 AND lat - 0.0505 <= 51.7",
)
def _(spark, sf):
    return query(areas(spark, sf), select="c_custkey", polygon=geo.bounds_ring(**BOUNDS))


# The place of a square nearest to a point: the point itself where it is inside.
_SQUARE = [f"greatest({c} - 0.0505, least({c} + 0.0505, {at}))" for c, at in (("lon", "0.1"), ("lat", "51.5"))]


@check("distance_filter_areas", f"SELECT c_custkey FROM ({SITES_SQL}) s WHERE {_near_sql(*_SQUARE)}")
def _(spark, sf):
    return query(areas(spark, sf), select="c_custkey", distance="0.1,51.5,60000")


def _bays(points: int) -> list[tuple[float, float]]:
    """A closed ring with bays, as an area's outline has."""
    around = [2 * math.pi * i / points for i in range(points)]
    ring = [(round((1 + 0.3 * math.sin(9 * a)) * math.cos(a), 6), round(51.5 + (1 + 0.3 * math.sin(9 * a)) * math.sin(a), 6)) for a in around]
    return [*ring, ring[0]]


LARGE_RING = _bays(2000)
_LARGE_EDGES = ", ".join(f"({x1}::DOUBLE, {y1}::DOUBLE, {x2}::DOUBLE, {y2}::DOUBLE)" for (x1, y1), (x2, y2) in zip(LARGE_RING, LARGE_RING[1:]) if y1 != y2)


@check(
    "polygon_filter_large",
    f"""SELECT c_custkey FROM ({SITES_SQL}) s JOIN (VALUES {_LARGE_EDGES}) e(x1, y1, x2, y2)
       ON (lat < y1) <> (lat < y2) AND lon < (lat - y1) * ((x2 - x1) / (y2 - y1)) + x1 GROUP BY c_custkey HAVING COUNT(*) % 2 = 1""",
)
def _(spark, sf):
    return query(frame(spark, sf, SITES), select="c_custkey", polygon=LARGE_RING)


def spatial_catalog(spark, sf) -> Catalog:
    catalog = Catalog(spark)
    sites = frame(spark, sf, SITES)
    catalog.register("grid_primary_sites", sites.where("c_custkey % 2 = 0"))
    catalog.register("secondary_sites", sites.where("c_custkey % 2 = 1"))
    # Not there: this table becomes an error entry and the others go on.
    catalog.register("lv_poles", f"{sf}/no_such_table.parquet")
    return catalog


_EDGE = "lon >= -0.5 AND lon < 0.2 AND lat >= 51.3 AND lat < 51.7"


@check(
    "bounds_query",
    f"SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'grid_primary_sites' ELSE 'secondary_sites' END AS dataset FROM ({SITES_SQL}) s WHERE {_EDGE}",
)
def _(spark, sf):
    found = query_bounds(spatial_catalog(spark, sf), BOUNDS, ["grid_primary_sites", "secondary_sites", "lv_poles"], limit=None)
    return found.union().select("c_custkey", "dataset")


@check(
    "bounds_status",
    f"SELECT CASE WHEN c_custkey % 2 = 0 THEN 'grid_primary_sites' ELSE 'secondary_sites' END AS dataset, COUNT(*) AS rows FROM ({SITES_SQL}) s WHERE {_EDGE} GROUP BY 1",
)
def _(spark, sf):
    return query_bounds(spatial_catalog(spark, sf), BOUNDS, ["grid_primary_sites", "secondary_sites"], limit=None).status()


@check(
    "bounds_fetched",
    f"""SELECT CASE WHEN c_custkey % 2 = 0 THEN 'grid_primary_sites' ELSE 'secondary_sites' END AS dataset, COUNT(*) AS rows, false AS failed
        FROM ({SITES_SQL}) s WHERE {_EDGE} GROUP BY 1 UNION ALL SELECT 'lv_poles', NULL, true""",
)
def _(spark, sf):
    found = fetch_bounds(spatial_catalog(spark, sf), BOUNDS, ["grid_primary_sites", "secondary_sites", "lv_poles"])
    return report(found, spark).select("dataset", "rows", F.col("error").isNotNull().alias("failed"))


def indexed(spark, df, name: str):
    """A table laid out by cell, written and read again."""
    path = new_path(spark, name)
    write_indexed(df, path, rows_per_file=200_000, row_group_bytes=64 << 10)
    return spark.read.parquet(path)


@check("polygon_filter_indexed", f"SELECT c_custkey FROM ({SITES_SQL}) s WHERE lon + 0.0505 >= -0.5 AND lon - 0.0505 <= 0.2 AND lat + 0.0505 >= 51.3 AND lat - 0.0505 <= 51.7")
def _(spark, sf):
    return query(indexed(spark, areas(spark, sf), "areas_by_cell"), polygon=geo.bounds_ring(**BOUNDS)).select("c_custkey")


@check("polygon_filter_indexed_points", f"SELECT c_custkey FROM ({SITES_SQL}) s WHERE {_ray_sql('lon', 'lat')}")
def _(spark, sf):
    return query(indexed(spark, frame(spark, sf, SITES), "sites_by_cell"), select="c_custkey", polygon=RING)


@check("distance_filter_indexed", f"SELECT c_custkey FROM ({SITES_SQL}) s WHERE {_near_sql(*_SQUARE)}")
def _(spark, sf):
    return query(indexed(spark, areas(spark, sf), "areas_by_cell"), select="c_custkey", distance="0.1,51.5,60000")


# A point and a square beside it in one collection.
@check(
    "polygon_filter_collections",
    f"""SELECT c_custkey FROM ({SITES_SQL}) s WHERE ({_EDGE})
        OR (lon + 0.5505 >= -0.5 AND lon + 0.4495 <= 0.2 AND lat + 0.0505 >= 51.3 AND lat - 0.0505 <= 51.7)""",
)
def _(spark, sf):
    h = 0.0505
    ring = F.array(*[F.array(F.col("lon") + 0.5 + dx, F.col("lat") + dy) for dx, dy in ((-h, -h), (-h, h), (h, h), (h, -h), (-h, -h))])
    square = F.to_json(F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")))
    point = F.to_json(F.struct(F.lit("Point").alias("type"), F.array("lon", "lat").alias("coordinates")))
    both = F.concat(F.lit('{"type":"GeometryCollection","geometries":['), point, F.lit(","), square, F.lit("]}"))
    return query(frame(spark, sf, SITES).select("c_custkey", both.alias("geo_shape")), select="c_custkey", polygon=geo.bounds_ring(**BOUNDS))


def _lines(spark, sf):
    start, end = F.array("lon", "lat", F.lit(12.5)), F.array(F.col("lon") + 0.01, "lat", F.lit(13.5))
    shape = F.to_json(F.struct(F.lit("LineString").alias("type"), F.array(start, end).alias("coordinates")))
    return frame(spark, sf, SITES).select("c_custkey", "lon", "lat", shape.alias("geo_shape"))


@check("strip_z", f"SELECT c_custkey, CAST(2 AS BIGINT) AS first_size, CAST(2 AS BIGINT) AS last_size, lon FROM ({SITES_SQL}) s", digits=3)
def _(spark, sf):
    rows = _lines(spark, sf).withColumn("g", geo.strip_z(F.col("geo_shape")))
    c = F.from_json(F.get_json_object("g", "$.coordinates"), "array<array<double>>")
    return rows.select("c_custkey", F.size(c[0]).alias("first_size"), F.size(c[1]).alias("last_size"), c[0][0].alias("lon"))


@check("ensure_z", f"SELECT c_custkey, CAST(3 AS BIGINT) AS size, 7.5::DOUBLE AS z, lat FROM ({SITES_SQL}) s", digits=3)
def _(spark, sf):
    point = F.to_json(F.struct(F.lit("Point").alias("type"), F.array("lon", "lat").alias("coordinates")))
    rows = frame(spark, sf, SITES).withColumn("g", geo.ensure_z(point, 7.5))
    c = F.from_json(F.get_json_object("g", "$.coordinates"), "array<double>")
    return rows.select("c_custkey", F.size(c).alias("size"), c[2].alias("z"), c[1].alias("lat"))


@check("geojson_features", f"SELECT c_custkey, lon, lat, 'LineString' AS kind FROM ({SITES_SQL}) s", digits=3)
def _(spark, sf):
    out = geojson_features(_lines(spark, sf), "2d")
    number = {"lon": "$.properties.lon", "lat": "$.properties.lat"}
    return out.select(
        F.get_json_object("value", "$.properties.c_custkey").cast("long").alias("c_custkey"),
        *[F.get_json_object("value", path).cast("double").alias(n) for n, path in number.items()],
        F.get_json_object("value", "$.geometry.type").alias("kind"),
    )

