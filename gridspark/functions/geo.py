"""Geometry as Column expressions over GeoJSON text."""

from __future__ import annotations

import json
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridspark.functions.cells import may_meet

# Geometry fields in order of preference.
GEO_FIELDS = ("geo_shape", "spatial_coordinates", "geo_point_2d", "geo_point", "geopoint")
# Mean Earth radius in metres.
EARTH_RADIUS = 6_371_008.8
# Nesting of coordinates per geometry type.
_DEPTH = {"Point": 1, "MultiPoint": 2, "LineString": 2, "MultiLineString": 3, "Polygon": 3, "MultiPolygon": 4}


def _once(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once per row, however often it is used."""
    return F.transform(F.array(value), use)[0]


def geo_text(df: DataFrame, field: str) -> Column:
    """A geometry column as JSON text, whether it was read as text or as a struct."""
    c = F.col(f"`{field}`")
    return F.to_json(c) if isinstance(df.schema[field].dataType, T.StructType) else c.cast("string")


def unwrap_feature(geometry: Column) -> Column:
    """The geometry inside a GeoJSON Feature; other values unchanged."""
    is_feature = F.coalesce(F.get_json_object(geometry, "$.type") == "Feature", F.lit(False))
    return F.when(is_feature, F.get_json_object(geometry, "$.geometry")).otherwise(geometry)


def unwrap_features(df: DataFrame) -> DataFrame:
    """Unwrap Features in the known geometry columns of a frame; these come out as text."""
    return df.withColumns({f: unwrap_feature(geo_text(df, f)) for f in GEO_FIELDS if f in df.columns})


def usable_geometry(value: Column) -> Column:
    """GeoJSON geometry of a value: a geometry as it is, ``{lat, lon}`` as a Point, else null."""

    def usable(g: Column) -> Column:
        lon, lat = (F.get_json_object(g, f"$.{k}").try_cast("double") for k in ("lon", "lat"))
        numbers = F.concat_ws(",", lon.cast("string"), lat.cast("string"))
        point = F.concat(F.lit('{"type":"Point","coordinates":['), numbers, F.lit("]}"))
        inner = F.coalesce(F.get_json_object(g, "$.coordinates"), F.get_json_object(g, "$.geometries"))
        whole = F.get_json_object(g, "$.type").isNotNull() & inner.isNotNull()
        return F.when(whole, g).when(lon.isNotNull() & lat.isNotNull(), point)

    return _once(unwrap_feature(value), usable)


def resolve_geometry(df: DataFrame) -> Column:
    """First usable geometry among the known fields of a row."""
    found = [usable_geometry(geo_text(df, f)) for f in GEO_FIELDS if f in df.columns]
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def point_lon(geometry: Column) -> Column:
    return F.when(F.get_json_object(geometry, "$.type") == "Point", F.get_json_object(geometry, "$.coordinates[0]").try_cast("double"))


def point_lat(geometry: Column) -> Column:
    return F.when(F.get_json_object(geometry, "$.type") == "Point", F.get_json_object(geometry, "$.coordinates[1]").try_cast("double"))


def _coordinates(geometry: Column, depth: int) -> Column:
    dtype = "double"
    for _ in range(depth):
        dtype = f"array<{dtype}>"
    return F.from_json(F.get_json_object(geometry, "$.coordinates"), dtype)


def _per_leaf(coordinates: Column, depth: int, change) -> Column:
    if depth == 1:
        return change(coordinates)
    return F.transform(coordinates, lambda c: _per_leaf(c, depth - 1, change))


def _with_leaves(geometry: Column, change) -> Column:
    def changed(g: Column) -> Column:
        kind = F.get_json_object(g, "$.type")
        out = None
        for name, depth in _DEPTH.items():
            moved = _per_leaf(_coordinates(g, depth), depth, change).alias("coordinates")
            text = F.to_json(F.struct(F.lit(name).alias("type"), moved))
            out = F.when(kind == name, text) if out is None else out.when(kind == name, text)
        return out.otherwise(g)

    return _once(geometry, changed)


def strip_z(geometry: Column) -> Column:
    """Keep the first two numbers of every coordinate."""
    return _with_leaves(geometry, lambda c: F.slice(c, 1, 2))


def ensure_z(geometry: Column, z: float = 0.0) -> Column:
    """Give every coordinate of two numbers a third."""
    return _with_leaves(geometry, lambda c: F.when(F.size(c) < 3, F.concat(c, F.array(F.lit(float(z))))).otherwise(c))


# --- predicates -------------------------------------------------------------------------------

Ring = Sequence[tuple[float, float]]


def bounds_ring(north: float, south: float, east: float, west: float) -> list[tuple[float, float]]:
    """Closed ring of a bounding box as (lon, lat)."""
    return [(west, south), (west, north), (east, north), (east, south), (west, south)]


def parse_ring(text: str) -> list[tuple[float, float]]:
    """``"(lon,lat),(lon,lat),..."`` as numbers."""
    numbers = [float(n) for n in text.replace("(", "").replace(")", "").split(",")]
    return list(zip(numbers[0::2], numbers[1::2]))


def _edges(ring: Ring) -> list[tuple[float, float, float, float]]:
    closed = list(ring) if tuple(ring[0]) == tuple(ring[-1]) else [*ring, ring[0]]
    return [(*map(float, a), *map(float, b)) for a, b in zip(closed, closed[1:])]


def _box(ring: Ring) -> tuple[float, float, float, float]:
    xs, ys = [float(p[0]) for p in ring], [float(p[1]) for p in ring]
    return min(xs), max(xs), min(ys), max(ys)


def _bands(edges: Sequence[tuple[float, float, float, float]], south: float, north: float) -> list[list[tuple[float, float, float, float]]]:
    """The edges that reach into each of a number of level bands between south and north, as many as there are edges at most.

    Long edges stand in many bands: bands become fewer until all lists together have eight times the edges at most.
    """
    count = max(1, len(edges))
    while count > 1 and sum(_band(max(y1, y2), south, north, count) - _band(min(y1, y2), south, north, count) + 1 for _, y1, _, y2 in edges) > 8 * len(edges):
        count //= 2
    bands: list[list[tuple[float, float, float, float]]] = [[] for _ in range(count)]
    for edge in edges:
        for at in range(_band(min(edge[1], edge[3]), south, north, count), _band(max(edge[1], edge[3]), south, north, count) + 1):
            bands[at].append(edge)
    return bands


def _band(y: float, south: float, north: float, count: int) -> int:
    return min(count - 1, max(0, math.floor((y - south) / ((north - south) or 1.0) * count)))


def _band_of(y: Column, south: float, north: float, count: int) -> Column:
    """:func:`_band` of a column: the same steps on the same doubles, and never falling in y, so no edge is missed."""
    at = F.floor((y.cast("double") - F.lit(south)) / F.lit((north - south) or 1.0) * F.lit(float(count)))
    return F.when(y.isNotNull(), F.least(F.lit(count - 1), F.greatest(F.lit(0), at))).cast("int")


def _banded(bands: Sequence[Sequence[Sequence[float]]], names: Sequence[str]) -> Column:
    """Lists of rows of numbers as one constant array of arrays of structs."""
    fields = ",".join(f"{n}:double" for n in names)
    return F.from_json(F.lit(json.dumps([[dict(zip(names, r)) for r in band] for band in bands])), f"array<array<struct<{fields}>>>")


def point_in_ring(lon: Column, lat: Column, ring: Ring) -> Column:
    """Even-odd test of a point, after a bounding-box test that a scan can use; only edges in the point's level band are looked at."""
    west, east, south, north = _box(ring)
    # Level edges are never crossed.
    bands = _bands([e for e in _edges(ring) if e[1] != e[3]], south, north)
    slopes = _banded([[(x1, y1, y2, (x2 - x1) / (y2 - y1)) for x1, y1, x2, y2 in band] for band in bands], ("x1", "y1", "y2", "slope"))

    def odd(at: Column) -> Column:
        x, y = at["x"], at["y"]

        def crossed(e: Column) -> Column:
            return F.when(((y < e["y1"]) != (y < e["y2"])) & (x < (y - e["y1"]) * e["slope"] + e["x1"]), 1).otherwise(0)

        near = F.get(slopes, _band_of(y, south, north, len(bands)))
        return F.coalesce(F.aggregate(near, F.lit(0), lambda acc, e: acc + crossed(e)), F.lit(0)) % 2 == 1

    # Place columns may be long expressions, which a filter would work out again for every edge.
    return lon.between(west, east) & lat.between(south, north) & _once(F.struct(lon.alias("x"), lat.alias("y")), odd)


def geometry_paths(geometry: Column) -> Column:
    """All coordinate paths of a geometry as ``array<array<array<double>>>``."""

    def paths(kind: Column) -> Column:
        return (
            F.when(kind == "Point", F.array(F.array(_coordinates(geometry, 1))))
            .when(kind == "MultiPoint", F.transform(_coordinates(geometry, 2), lambda c: F.array(c)))
            .when(kind == "LineString", F.array(_coordinates(geometry, 2)))
            .when(kind.isin("MultiLineString", "Polygon"), _coordinates(geometry, 3))
            .when(kind == "MultiPolygon", F.flatten(_coordinates(geometry, 4)))
        )

    return _once(F.get_json_object(geometry, "$.type"), paths)


def members(geometry: Column) -> Column:
    """The plain geometries of a geometry: itself, or those of a GeometryCollection (and of collections directly in it)."""

    def of(g: Column) -> Column:
        several = F.from_json(F.get_json_object(g, "$.geometries"), "array<string>")
        return F.when(F.get_json_object(g, "$.type") == "GeometryCollection", several).otherwise(F.array(g))

    return _once(geometry, lambda g: F.flatten(F.transform(of(g), of)))


def geometry_box(geometry: Column) -> Column:
    """``[west, east, south, north]`` of everything in a geometry; null without a usable coordinate."""

    def box(points: Column) -> Column:
        x, y = F.transform(points, lambda c: c[0]), F.transform(points, lambda c: c[1])
        return F.when(F.size(points) > 0, F.array(F.array_min(x), F.array_max(x), F.array_min(y), F.array_max(y)))

    points = F.flatten(F.flatten(F.filter(F.transform(members(geometry), geometry_paths), lambda p: p.isNotNull())))
    return _once(points, lambda p: box(F.filter(p, lambda c: F.size(c) > 1)))


def _side(ax, ay, bx, by, cx, cy) -> Column:
    return F.signum((bx - ax) * (cy - ay) - (by - ay) * (cx - ax))


def _segments(path: Column) -> Column:
    """Pairs of neighbouring points of a path."""
    n = F.size(path)
    return F.arrays_zip(F.slice(path, 1, F.greatest(n - 1, F.lit(0))).alias("a"), F.slice(path, 2, F.greatest(n - 1, F.lit(0))).alias("b"))


def _crosses(seg: Column, edge: Column) -> Column:
    x1, y1, x2, y2 = (edge[n] for n in ("x1", "y1", "x2", "y2"))
    ax, ay, bx, by = seg["a"][0], seg["a"][1], seg["b"][0], seg["b"][1]
    return (_side(x1, y1, x2, y2, ax, ay) != _side(x1, y1, x2, y2, bx, by)) & (
        _side(ax, ay, bx, by, x1, y1) != _side(ax, ay, bx, by, x2, y2)
    )


def _any_point(paths: Column, test) -> Column:
    return F.exists(paths, lambda p: F.exists(p, test))


def _any_segment(paths: Column, test) -> Column:
    return F.exists(paths, lambda p: F.exists(_segments(p), test))


def _around(paths: Column, px: Column, py: Column) -> Column:
    """Whether the paths, taken as rings of an area, have the point inside."""

    def ray(seg: Column) -> Column:
        ax, ay, bx, by = seg["a"][0], seg["a"][1], seg["b"][0], seg["b"][1]
        at = (py - ay) / F.nullif(by - ay, F.lit(0.0)) * (bx - ax) + ax
        return F.when(((ay > py) != (by > py)) & (px < at), 1).otherwise(0)

    def count(path: Column) -> Column:
        return F.aggregate(_segments(path), F.lit(0), lambda acc, s: acc + ray(s))

    return F.aggregate(paths, F.lit(0), lambda acc, p: acc + count(p)) % 2 == 1


def _overlaps(paths: Column, axis: int, low: float, high: float) -> Column:
    """Whether the extent of the paths along an axis meets an interval."""
    along = F.flatten(F.transform(paths, lambda p: F.transform(p, lambda c: c[axis])))
    return (F.array_max(along) >= low) & (F.array_min(along) <= high)


def _is_area(geometry: Column) -> Column:
    return F.get_json_object(geometry, "$.type").isin("Polygon", "MultiPolygon")


def intersects_ring(geometry: Column, ring: Ring) -> Column:
    """Whether a geometry meets a ring.

    A vertex inside the ring, an edge across it, or (for areas) the ring lying wholly inside. Bounding
    boxes are compared first: of the geometry, then of each of its segments.
    """
    west, east, south, north = _box(ring)
    bands = _bands(_edges(ring), south, north)
    edges = _banded(bands, ("x1", "y1", "x2", "y2"))
    px, py = (F.lit(float(v)) for v in ring[0])

    def across(seg: Column) -> Column:
        a, b = seg["a"], seg["b"]
        near = (F.greatest(a[0], b[0]) >= west) & (F.least(a[0], b[0]) <= east)
        near = near & (F.greatest(a[1], b[1]) >= south) & (F.least(a[1], b[1]) <= north)
        # Edges of the bands that the segment reaches into: others lie above or below it.
        low, high = (_band_of(f(a[1], b[1]), south, north, len(bands)) for f in (F.least, F.greatest))
        reached = F.slice(edges, low + 1, F.greatest(high - low + 1, F.lit(0)))
        return near & F.exists(reached, lambda band: F.exists(band, lambda e: _crosses(seg, e)))

    def meets(g: Column) -> Column:
        def tests(paths: Column) -> Column:
            box = _overlaps(paths, 0, west, east) & _overlaps(paths, 1, south, north)
            vertex = _any_point(paths, lambda c: point_in_ring(c[0], c[1], ring))
            return box & (vertex | _any_segment(paths, across) | (_is_area(g) & _around(paths, px, py)))

        return _once(geometry_paths(g), tests)

    return F.coalesce(F.exists(members(geometry), meets), F.lit(False))


def _lonlat(df: DataFrame) -> tuple[Column, Column] | None:
    if "lon" in df.columns and "lat" in df.columns:
        return F.col("lon"), F.col("lat")
    return None


def within_polygon(df: DataFrame, polygon: Ring | str) -> Column:
    """Rows whose geometry (or lon/lat columns) meets the polygon; index columns, where there are any, are looked at first."""
    ring = parse_ring(polygon) if isinstance(polygon, str) else list(polygon)
    at = _lonlat(df)
    inside = point_in_ring(*at, ring) if at else intersects_ring(resolve_geometry(df), ring)
    near = may_meet(df.columns, ring)
    return inside if near is None else near & inside


def great_circle_metres(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Haversine distance."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    a = F.pow(F.sin((p2 - p1) / 2), F.lit(2.0)) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), F.lit(2.0))
    return 2 * EARTH_RADIUS * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def near_point(geometry: Column, lon: float, lat: float, metres: float, reach: float, wide: float | None) -> Column:
    """Whether any part of a geometry lies within ``metres`` of a point; an area that holds the point does.

    The place of a segment nearest to the point is found on a plane around the point, its distance on
    the sphere. ``reach`` and ``wide`` are the half sides of the box in degrees (no ``wide``: any longitude).
    """
    x0, y0, shrink = F.lit(lon), F.lit(lat), math.cos(math.radians(lat))

    def near(x: Column, y: Column) -> Column:
        return great_circle_metres(x, y, x0, y0) <= metres

    def segment(seg: Column) -> Column:
        a, b = seg["a"], seg["b"]
        ax, ay = (a[0] - lon) * shrink, a[1] - lat
        dx, dy = (b[0] - a[0]) * shrink, b[1] - a[1]
        share = F.coalesce(-(ax * dx + ay * dy) / F.nullif(dx * dx + dy * dy, F.lit(0.0)), F.lit(0.0))
        share = F.greatest(F.lit(0.0), F.least(F.lit(1.0), share))
        return near(a[0] + share * (b[0] - a[0]), a[1] + share * (b[1] - a[1]))

    def meets(g: Column) -> Column:
        def tests(paths: Column) -> Column:
            box = _overlaps(paths, 1, lat - reach, lat + reach)
            if wide is not None:
                box = box & _overlaps(paths, 0, lon - wide, lon + wide)
            vertex = _any_point(paths, lambda c: near(c[0], c[1]))
            return box & (vertex | _any_segment(paths, segment) | (_is_area(g) & _around(paths, x0, y0)))

        return _once(geometry_paths(g), tests)

    return F.coalesce(F.exists(members(geometry), meets), F.lit(False))


def within_distance(df: DataFrame, distance: tuple[float, float, float] | str) -> Column:
    """Rows within ``lon, lat, metres``, by any part of their geometry; a bounding box goes first."""
    lon, lat, metres = (float(x) for x in (distance.split(",") if isinstance(distance, str) else distance))
    reach = math.degrees(metres / EARTH_RADIUS) * 1.001
    top, wide = abs(lat) + reach, None
    if top < 89.9:
        half = math.degrees(2 * math.asin(min(1.0, math.sin(math.radians(min(reach, 180)) / 2) / math.cos(math.radians(top))))) * 1.001
        # A box over the date line is left to the distance itself.
        wide = half if -180 <= lon - half and lon + half <= 180 else None
    around = None if wide is None else may_meet(df.columns, bounds_ring(lat + reach, lat - reach, lon + wide, lon - wide))
    at = _lonlat(df)
    if at is None:
        close = near_point(resolve_geometry(df), lon, lat, metres, reach, wide)
        return close if around is None else around & close
    x, y = at
    box = y.between(lat - reach, lat + reach)
    if wide is not None:
        box = box & x.between(lon - wide, lon + wide)
    if around is not None:
        box = around & box
    return F.coalesce(box & (great_circle_metres(x, y, F.lit(lon), F.lit(lat)) <= metres), F.lit(False))
