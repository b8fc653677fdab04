"""Pages at any depth: a position index over ranges of the sort key, and pages after a known row.

Spark's own ``offset`` sends everything up to the page through one task. Here the rows are counted per range of the sort
key; ranges before the page are skipped as a whole, the range that holds its border is cut again until it is small, and
only that small one is sorted to leave out its first rows. Rows are filtered by their keys, never moved.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A page that ends within so many rows is found by Spark's top-k, whose tasks hold that many rows each.
SHALLOW_ROWS = 100_000
#: Ranges per cut, and sampled rows per range.
RANGES = 16
_SAMPLED = 100


@dataclass(frozen=True)
class Key:
    """One sort key: ascending with nulls first, or descending with nulls last, as Spark sorts."""

    column: Column
    down: bool = False

    def order(self) -> Column:
        return self.column.desc() if self.down else self.column.asc()

    def before(self, a: Column, b: Column) -> Column:
        a, b = (b, a) if self.down else (a, b)
        return F.coalesce(a < b, a.isNull() & b.isNotNull())


def parse_keys(order_by: str | None, tiebreak: Sequence[str] = ()) -> list[Key]:
    """``"f"``, ``"-f"`` or ``"f desc"``, comma separated; ``tiebreak`` columns follow in ascending order."""
    keys = []
    for part in (order_by or "").split(","):
        name, _, way = part.strip().partition(" ")
        if name:
            keys.append(Key(F.col(name.lstrip("-")), name.startswith("-") or way.strip().lower() == "desc"))
    return keys + [Key(F.col(t)) for t in tiebreak]


def row_hash_keys(df: DataFrame) -> list[Key]:
    """Keys that put rows in an order of their own content, whatever the layout: two hashes of the whole row.

    Rows that tie are equal, but for hashes of 96 bits that collide.
    """
    cells = [F.col(f"`{f.name}`") if isinstance(f.dataType, T.AtomicType) else F.to_json(F.struct(F.col(f"`{f.name}`"))) for f in df.schema.fields] or [F.lit(0)]
    # A hash passes over nulls: where they stand is hashed as well.
    cells.append(F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in cells]))
    return [Key(F.xxhash64(*cells)), Key(F.hash(*cells))]


@dataclass
class _Range:
    """Rows from border ``low`` on and before ``high``; None is open.

    A border is (key values, after them): the rows that have these values lie behind it, or before it if the flag is
    set. It may hold the first keys only. Two borders of the same values have nothing but these values between them.
    """

    low: tuple | None
    high: tuple | None
    rows: int
    inside: list[_Range] | None = field(default=None)

    def one_value(self) -> int:
        """Of how many keys all rows have the same value, by the borders."""
        return len(self.low[0]) if self.low and self.high and self.low[0] == self.high[0] else 0


class PageIndex:
    """Positions of the rows of ``df`` in the order given; without one, in an order of the rows' content.

    Building it counts the rows; a page then cuts the ranges at its borders and remembers the cuts for later pages.
    Each cut is a sample of keys and a count per range, so at most RANGES rows reach the driver besides the sample.
    """

    def __init__(self, df: DataFrame, order_by: str | None = None, tiebreak: Sequence[str] = (), small: int = SHALLOW_ROWS, ranges: int = RANGES):
        self.df = df
        self.asked = parse_keys(order_by, tiebreak)
        # Rows that the order leaves tied are told apart by their content, but only where that is needed.
        self.keys = [*self.asked, *row_hash_keys(df)]
        self._types = [f.dataType for f in df.select(*[k.column for k in self.keys]).schema.fields]
        self.small, self.ranges = small, ranges
        self.total = df.count()
        self._top = _Range(None, None, self.total)

    def page(self, offset: int = 0, limit: int | None = None) -> DataFrame:
        """Rows ``offset`` to ``offset + limit`` of the order, sorted if an order was given."""
        last = self.total if limit is None else min(self.total, offset + limit)
        if offset >= last:
            return self.df.limit(0)
        parts = self._between(self._top, offset, last)
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out.orderBy(*[k.order() for k in self.asked]) if self.asked else out

    def pages(self, size: int) -> Iterator[DataFrame]:
        """All pages of ``size`` rows, one after the other."""
        for offset in range(0, self.total, size):
            yield self.page(offset, size)

    def _between(self, r: _Range, start: int, end: int) -> list[DataFrame]:
        """Rows ``start`` to ``end`` of a range, as few filters as will do."""
        if start <= 0 and end >= r.rows:
            return [self._rows(r.low, r.high)]
        if r.rows <= self.small:
            found = self._rows(r.low, r.high).orderBy(*[k.order() for k in self.keys])
            return [(found.offset(start) if start > 0 else found).limit(min(end, r.rows) - max(start, 0))]
        if r.one_value() == len(self.keys):
            return [self._copies(r, min(end, r.rows) - max(start, 0))]
        if r.inside is None:
            r.inside = self._cut(r)
        out, at, whole = [], 0, None
        for x in [*r.inside, None]:
            inner = x is not None and start <= at and at + x.rows <= end
            if inner:
                whole = (whole[0] if whole else x.low, x.high)  # neighbouring whole ranges share a filter
            elif whole:
                out.append(self._rows(*whole))
                whole = None
            if x is not None:
                if not inner and at < end and start < at + x.rows:
                    out += self._between(x, start - at, end - at)
                at += x.rows
        return out

    def _cut(self, r: _Range) -> list[_Range]:
        """About RANGES ranges; a value that is sampled again and again gets one of its own."""
        keys = self.keys if r.one_value() or not self.asked else self.asked
        rows = self._rows(r.low, r.high)
        names = [f"_k{i}" for i in range(len(keys))]
        only = rows.select(*[k.column.alias(n) for k, n in zip(keys, names)])
        order = [F.col(n).desc() if k.down else F.col(n).asc() for k, n in zip(keys, names)]
        share = min(1.0, _SAMPLED * self.ranges / r.rows)
        sample = [tuple(x) for x in only.sample(share, seed=7).orderBy(*order).collect()] or [tuple(only.first())]
        step = max(1, len(sample) // self.ranges)
        picked = Counter(sample[step // 2 :: step])
        bounds = [(v, after) for v, n in picked.items() for after in ((False, True) if n > 1 or len(picked) == 1 else (False,))]
        place = F.lit(0)
        for b in bounds:
            place = place + self._reached(b).cast("int")
        counts = dict(rows.groupBy(place.alias("_place")).agg(F.count("*").alias("_n")).collect())
        edges = [r.low, *bounds, r.high]
        return [_Range(edges[i], edges[i + 1], n) for i, n in sorted(counts.items())]

    def _copies(self, r: _Range, n: int) -> DataFrame:
        """``n`` of the equal rows of a range: one of them, repeated."""
        one = self._rows(r.low, r.high).limit(1)
        return one.withColumn("_copy_number", F.explode(F.sequence(F.lit(1), F.lit(n)))).drop("_copy_number")

    def _reached(self, border: tuple) -> Column:
        """Whether a row lies behind a border."""
        values, after = border
        out = F.lit(not after)
        for k, v, t in reversed(list(zip(self.keys, values, self._types))):
            value = F.lit(v).cast(t)
            out = k.before(value, k.column) | (k.column.eqNullSafe(value) & out)
        return out

    def _rows(self, low: tuple | None, high: tuple | None) -> DataFrame:
        cond = F.lit(True)
        if low is not None:
            cond = cond & self._reached(low) & self._coarse(low[0][0], True)
        if high is not None:
            cond = cond & ~self._reached(high) & self._coarse(high[0][0], False)
        return self.df.where(cond)

    def _coarse(self, value, from_low: bool) -> Column:
        """What the bound says about the first key alone, in a form that a scan can use."""
        key = self.keys[0]
        if value is None:
            return F.lit(True)
        after = from_low != key.down
        plain = key.column >= F.lit(value) if after else key.column <= F.lit(value)
        # Nulls come before ascending and after descending values.
        return plain if from_low != key.down else plain | key.column.isNull()


def page(df: DataFrame, order_by: str | None = None, limit: int | None = None, offset: int = 0, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Sort, skip ``offset`` rows and take ``limit``; ``tiebreak`` columns make the order total.

    A page that begins deep in the table, or has no end, is found by a :class:`PageIndex`, which counts rows when this is called. Without an
    order an offset counts in an order of the rows' content, so that pages neither overlap nor leave rows out; a limit
    alone takes whichever rows come first.
    """
    if not offset:
        if order_by:
            df = df.orderBy(*[k.order() for k in parse_keys(order_by, tiebreak)])
        return df if limit is None else df.limit(limit)
    if limit is not None and offset + limit <= SHALLOW_ROWS:
        keys = parse_keys(order_by, tiebreak) if order_by else row_hash_keys(df)
        return df.orderBy(*[k.order() for k in keys]).offset(offset).limit(limit)
    return PageIndex(df, order_by, tiebreak if order_by else ()).page(offset, limit)


def page_after(df: DataFrame, order_by: str, after: Sequence, limit: int | None = None, tiebreak: Sequence[str] = ()) -> DataFrame:
    """The page that follows a row, given the values of its sort keys (ties included): no row before it is counted or sorted."""
    keys = parse_keys(order_by, tiebreak)
    if len(after) != len(keys):
        raise ValueError(f"{len(keys)} sort keys need as many values, not {len(after)}")
    types = [f.dataType for f in df.select(*[k.column for k in keys]).schema.fields]
    cond = F.lit(False)
    for k, v, t in reversed(list(zip(keys, after, types))):
        value = F.lit(v).cast(t)
        cond = k.before(value, k.column) | (k.column.eqNullSafe(value) & cond)
    first, value = keys[0], after[0]
    if value is not None:
        bound = F.lit(value).cast(types[0])
        cond = cond & ((first.column <= bound) | first.column.isNull() if first.down else first.column >= bound)
    out = df.where(cond).orderBy(*[k.order() for k in keys])
    return out if limit is None else out.limit(limit)
