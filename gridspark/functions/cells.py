"""Quadtree cells over longitude and latitude: rings as ranges of cell numbers, and conditions that a scan can use.

The world is halved LEVELS times each way; a cell of the lowest level is numbered along a Z-shaped curve, so that a cell
of any level is one range of numbers. A row carries the range of the smallest cell that holds its box, and the box.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

LEVELS = 16
#: Index columns: box, cell range, and the level that keeps wide shapes apart from narrow ones.
BOX = ("_west", "_east", "_south", "_north")
INDEX_COLUMNS = (*BOX, "_z", "_z_end", "_level")
#: Cells that a ring is covered with, at most.
MAX_CELLS = 32
_SIDE = 1 << LEVELS


def _step(value: Column, low: float, span: float) -> Column:
    cell = F.greatest(F.lit(0), F.least(F.lit(_SIDE - 1), F.floor((value - low) / span * _SIDE)))
    return F.when(value.isNotNull(), cell)  # the least of a null and a number is the number


def _spread(c: Column) -> Column:
    """A zero between any two bits."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        c = c.bitwiseOR(F.shiftleft(c, shift)).bitwiseAND(F.lit(mask).cast("long"))
    return c


def cell_columns(west: Column, east: Column, south: Column, north: Column) -> dict[str, Column]:
    """``_z, _z_end, _level`` of the smallest cell that holds a box."""
    x0, x1 = _step(west, -180.0, 360.0), _step(east, -180.0, 360.0)
    y0, y1 = _step(south, -90.0, 180.0), _step(north, -90.0, 180.0)
    apart = x0.bitwiseXOR(x1).bitwiseOR(y0.bitwiseXOR(y1))
    # Twice the number of low bits in which the corners differ: so many bits of the number are the cell's own.
    free = F.when(apart == 0, 0).otherwise(2 * (F.floor(F.log2(apart.cast("double"))) + 1)).cast("int")
    z = _spread(x0).bitwiseOR(F.shiftleft(_spread(y0), 1))
    start = F.call_function("shiftleft", F.call_function("shiftright", z, free), free)
    size = F.call_function("shiftleft", F.lit(1).cast("long"), free)
    return {"_z": start, "_z_end": start + size - 1, "_level": (F.lit(LEVELS) - free / 2).cast("int")}


Ring = Sequence[tuple[float, float]]


def _relation(box: tuple[float, float, float, float], edges: Sequence[tuple[float, float, float, float]]) -> str:
    """Whether a box lies outside a ring, inside it, or across its border."""
    west, east, south, north = box
    inside = False
    cx, cy = (west + east) / 2, (south + north) / 2
    for x1, y1, x2, y2 in edges:
        if max(x1, x2) >= west and min(x1, x2) <= east and max(y1, y2) >= south and min(y1, y2) <= north and _meets(box, x1, y1, x2, y2):
            return "across"
        if (cy < y1) != (cy < y2) and cx < (cy - y1) * (x2 - x1) / (y2 - y1) + x1:
            inside = not inside
    return "inside" if inside else "outside"


def _meets(box: tuple[float, float, float, float], x1: float, y1: float, x2: float, y2: float) -> bool:
    """Whether a segment, whose box meets this one, meets it too: not all corners on one side of its line."""
    west, east, south, north = box
    sides = [(x2 - x1) * (y - y1) - (y2 - y1) * (x - x1) for x in (west, east) for y in (south, north)]
    return min(sides) <= 0 <= max(sides)


def ring_ranges(ring: Ring, max_cells: int = MAX_CELLS) -> list[tuple[int, int]]:
    """Ranges of cell numbers that together hold everything a ring meets; largest cells are divided first."""
    closed = list(ring) if tuple(ring[0]) == tuple(ring[-1]) else [*ring, ring[0]]
    edges = [(*map(float, a), *map(float, b)) for a, b in zip(closed, closed[1:])]
    done: list[tuple[int, int]] = []
    todo = [(0, 0, edges)]  # level, number of the cell on its level, edges that may meet it
    while todo and len(todo) + len(done) < max_cells:
        level, number, near = heapq.heappop(todo)
        if level == LEVELS:
            done.append((level, number))
            continue
        for child in range(4 * number, 4 * number + 4):
            box = _cell_box(level + 1, child)
            relation = _relation(box, edges)
            if relation == "inside":
                done.append((level + 1, child))
            elif relation == "across":
                heapq.heappush(todo, (level + 1, child, near))
    cells = done + [(level, number) for level, number, _ in todo]
    ranges: list[tuple[int, int]] = []
    for low, high in sorted((n << 2 * (LEVELS - v), ((n + 1) << 2 * (LEVELS - v)) - 1) for v, n in cells):
        if ranges and low <= ranges[-1][1] + 1:
            ranges[-1] = (ranges[-1][0], max(high, ranges[-1][1]))
        else:
            ranges.append((low, high))
    return ranges


def _cell_box(level: int, number: int) -> tuple[float, float, float, float]:
    x = y = 0
    for bit in range(level):
        x |= (number >> 2 * bit & 1) << bit
        y |= (number >> 2 * bit + 1 & 1) << bit
    wide, high = 360.0 / (1 << level), 180.0 / (1 << level)
    return -180 + x * wide, -180 + (x + 1) * wide, -90 + y * high, -90 + (y + 1) * high


def may_meet(columns: Sequence[str], ring: Ring) -> Column | None:
    """Conditions on the index columns that every row meeting the ring fulfils; None where the columns are not there."""
    if not set(INDEX_COLUMNS) <= set(columns):
        return None
    xs, ys = [float(p[0]) for p in ring], [float(p[1]) for p in ring]
    box = (F.col("_west") <= max(xs)) & (F.col("_east") >= min(xs)) & (F.col("_south") <= max(ys)) & (F.col("_north") >= min(ys))
    if min(xs) < -180 or max(xs) > 180 or min(ys) < -90 or max(ys) > 90:
        return box
    cells = F.lit(False)
    for low, high in ring_ranges(ring):
        cells = cells | ((F.col("_z") <= high) & (F.col("_z_end") >= low))
    return box & cells
