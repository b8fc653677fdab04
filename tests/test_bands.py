"""Rings of many edges: a point is compared with the edges of its level band only, and the answer stays the same."""

from __future__ import annotations

import math
import random

from gridspark.functions import geo
from gridspark.operators.query import query


def crossings(x, y, ring):
    return sum((y < y1) != (y < y2) and x < (y - y1) * ((x2 - x1) / (y2 - y1)) + x1 for (x1, y1), (x2, y2) in zip(ring, ring[1:]) if y1 != y2)


def star(points, seed):
    r = random.Random(seed)
    ring = [((1 + r.random()) * math.cos(2 * math.pi * i / points), (1 + r.random()) * math.sin(2 * math.pi * i / points)) for i in range(points)]
    return [*ring, ring[0]]


def test_bands_hold_few_edges_and_none_is_missed():
    ring = [*[(math.cos(a / 1000 * math.pi), math.sin(a / 1000 * math.pi)) for a in range(2000)], (1.0, 0.0)]
    edges = [e for e in geo._edges(ring) if e[1] != e[3]]
    bands = geo._bands(edges, -1.0, 1.0)
    assert sum(map(len, bands)) <= 8 * len(edges)
    assert max(map(len, bands)) < len(edges) / 10
    # Edges from top to bottom would stand in every band: there is one band of all.
    comb = [(i / 500, float(i % 2), (i + 1) / 500, float((i + 1) % 2)) for i in range(500)]
    assert sum(map(len, geo._bands(comb, 0.0, 1.0))) <= 8 * len(comb)


def test_points_in_large_rings(spark):
    r = random.Random(7)
    for ring in (star(300, 1), star(7, 2), [(0, 0), (4, 0), (4, 4), (2, 1e-9), (0, 4), (0, 0)], [(0.0, 1.0), (2.0, 1.0), (0.0, 1.0)]):
        at = [(r.uniform(-3, 5), r.uniform(-3, 5)) for _ in range(300)]
        at += [(x + d, y) for x, y in ring for d in (-0.5, -1e-9, 0.0, 0.5)]
        odd = [(None, 0.5), (0.5, None), (float("nan"), 0.5), (0.5, float("nan")), (0.5, 1e300), (0.5, -1e300)]
        xs, ys = [p[0] for p in ring], [p[1] for p in ring]
        want = {i for i, (x, y) in enumerate(at) if min(xs) <= x <= max(xs) and min(ys) <= y <= max(ys) and crossings(x, y, ring) % 2}
        rows = spark.createDataFrame([(i, None if x is None else float(x), None if y is None else float(y)) for i, (x, y) in enumerate(at + odd)], "i int, lon double, lat double")
        assert {row.i for row in query(rows, select="i", polygon=ring).collect()} == want


def test_a_place_is_worked_out_once_a_row(spark):
    """A filter that is pushed below a projection brings its expressions along; they must not run once an edge."""
    worked = spark.range(4).selectExpr("id", "id / 10 + 0.01 AS lon", "sqrt(id) / 10 + 0.01 AS lat")
    plan = query(worked, select="id", polygon=star(300, 1))._jdf.queryExecution().optimizedPlan().toString()
    # Two in the box test, one in the edge test.
    assert plan.upper().count("SQRT(") <= 4


def test_segments_across_large_rings(spark):
    ring = star(300, 3)
    r = random.Random(5)

    def side(ax, ay, bx, by, cx, cy):
        v = (bx - ax) * (cy - ay) - (by - ay) * (cx - ax)
        return (v > 0) - (v < 0)

    def meets(a, b):
        if any(crossings(*p, ring) % 2 for p in (a, b)):
            return True
        return any(side(*p, *q, *a) != side(*p, *q, *b) and side(*a, *b, *p) != side(*a, *b, *q) for p, q in zip(ring, ring[1:]))

    lines = [tuple((r.uniform(-3, 3), r.uniform(-3, 3)) for _ in range(2)) for _ in range(150)]
    lines += [((x, y), (x + r.uniform(-0.2, 0.2), y + r.uniform(-0.2, 0.2))) for x, y in [(r.uniform(-3, 3), r.uniform(-3, 3)) for _ in range(150)]]
    rows = spark.createDataFrame([(i, '{"type":"LineString","coordinates":[[%r,%r],[%r,%r]]}' % (*a, *b)) for i, (a, b) in enumerate(lines)], "i int, geo_shape string")
    assert {row.i for row in query(rows, select="i", polygon=ring).collect()} == {i for i, (a, b) in enumerate(lines) if meets(a, b)}
