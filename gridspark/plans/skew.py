"""Ordered work on series of any size.

A window partitioned by the series key alone puts a whole series on one task. Here a series that is
too large for that is cut into time chunks; windows run per ``(keys, chunk)`` and a small per-chunk
summary carries state over the borders. Series below the limit keep a single chunk, so the same plan
serves both. Chunks are a matter of layout only: results do not depend on where the cuts are.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_log = logging.getLogger(__name__)

CHUNK = "_chunk"
POS = "_pos"
BLOCK = "_block"
HOME = "_home"
_SERIES = "_series"
_SIZE = "series_rows"

# Rows that one window task should hold.
TARGET_ROWS = 2_000_000
# Most entries a broadcast list of oversized groups may have (about 10 MB at 100 bytes each).
# Groups beyond it hold at most total/MAX_HOT_GROUPS rows each and stay whole.
MAX_HOT_GROUPS = 100_000
# A burst is cut at this many equal-depth boundaries per round, until no burst is left or none gets smaller.
_CUTS = 64
_MAX_BURSTS = 10_000
_WHOLE = {"whole": True}


def keyed(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Give a single series (no keys) a constant key so that every plan has one.

    Rows with a null key belong to no series and are left out, as a grouping by key leaves them out.
    """
    if keys:
        return df.dropna(subset=list(keys)), list(keys)
    return df.withColumn(_SERIES, F.lit(0)), [_SERIES]


def unkeyed(df: DataFrame, asked: Sequence[str]) -> DataFrame:
    """Drop the constant key again unless the caller had asked for it."""
    return df if asked else df.drop(_SERIES)


def hot_groups(df: DataFrame, group: Sequence[str], *aggs: Column, target_rows: int | None = None, limit: int = MAX_HOT_GROUPS, at_most: int | None = None) -> DataFrame | None:
    """Groups with more than ``target_rows`` rows, with their size ``_rows`` and ``aggs``; None if there are none.

    This runs one job when the plan is built, because the size decides the layout: ordinary data then
    gets a plan with no splitting at all. Counting combines on the map side, so a hot group sends one
    row per map task, and the result is small enough to broadcast whatever the data: at most
    ``limit`` rows. A caller that knows no group has more than ``at_most`` rows saves the job.
    """
    if at_most is None:
        at_most = known_size(df, group)
    if at_most is not None and at_most <= (target_rows or TARGET_ROWS):
        return None
    found = (
        df.groupBy(*group)
        .agg(F.count("*").alias("_rows"), *aggs)
        .where(F.col("_rows") > (target_rows or TARGET_ROWS))
        .orderBy(F.desc("_rows"))
        .limit(limit)
    )
    rows = found.collect()
    if len(rows) == limit:
        _log.warning("%d oversized groups of %s are listed; smaller ones stay whole", limit, list(group))
    return df.sparkSession.createDataFrame(rows, found.schema) if rows else None


def known_size(df: DataFrame, group: Sequence[str]) -> int | None:
    """Rows of the largest group as measured by an operator before, if its result came down to this frame."""
    for c in group:
        found = df.schema[c].metadata.get(_SIZE) if c in df.columns else None
        if found and set(found["keys"]) <= set(group):
            return found["rows"]
    return None


def sized(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, int]:
    """The frame with the rows of its largest series noted in its schema, and that number.

    The note stays with the key column through filters, projections and grouping, so that operators chained on the
    result measure nothing again. It is a matter of layout only: should later rows exceed it, results stay the same.
    """
    rows = largest_group(df, keys)
    note = {**df.schema[keys[0]].metadata, _SIZE: {"keys": list(keys), "rows": rows}}
    return df.withColumn(keys[0], F.col(keys[0]).alias(keys[0], metadata=note)), rows


def unsized(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The frame without such a note: for operators that add rows to a series."""
    noted = [c for c in keys if _SIZE in df.schema[c].metadata]
    return df.withColumns({c: F.col(c).alias(c, metadata={k: v for k, v in df.schema[c].metadata.items() if k != _SIZE}) for c in noted}) if noted else df


def largest_group(df: DataFrame, group: Sequence[str]) -> int:
    """Rows of the largest group: one number, for operators that lay out the same rows several times."""
    known = known_size(df, group)
    if known is not None:
        return known
    sizes = df.groupBy(*group).agg(F.count("*").alias("_rows"))
    return sizes.agg(F.max("_rows")).first()[0] or 0


def _as_number(df: DataFrame, column: str, skip: int = 0) -> Column:
    dtype = df.schema[column].dataType
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(column).cast("timestamp"))
    if isinstance(dtype, T.DateType):
        return F.unix_date(F.col(column)).cast("long")
    if isinstance(dtype, T.NumericType):
        return F.col(column).cast("double")
    # Text and the like: an order-preserving number from the six bytes after what all values begin with.
    text = F.col(column).cast("string")
    return F.conv(F.rpad(F.substring(F.hex(F.encode(text, "UTF-8")), 2 * skip + 1, 12), 12, "0"), 16, 10).cast("double")


def _common_bytes(df: DataFrame, column: str) -> int:
    """Leading bytes that all values of a text column share: one row with the smallest and the largest tells."""
    if isinstance(df.schema[column].dataType, (T.TimestampType, T.TimestampNTZType, T.DateType, T.NumericType)):
        return 0
    low, high = (str(v or "").encode() for v in df.agg(F.min(column), F.max(column)).first())
    same = 0
    while same < min(len(low), len(high)) and low[same] == high[same]:
        same += 1
    return same


def _has_map(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _has_map(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return any(_has_map(f.dataType) for f in dtype.fields)
    return isinstance(dtype, T.MapType)


def split_hot(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    tiebreak: str | None = None,
    target_rows: int | None = None,
    at_most: int | None = None,
) -> DataFrame:
    """Add ``_chunk``: 0 for ordinary series, ascending along ``order`` for oversized ones.

    First an oversized series is cut into equal time cells. A cell that is still oversized (a burst)
    is cut at equal-depth boundaries, which leaves a single crowded instant in a chunk of its own;
    that is then cut along ``tiebreak`` (without one, along a hash of the row: the order of equal times
    is then undefined anyway). All lists of cuts are bounded and broadcast; the rows
    themselves are not shuffled.
    """
    target = target_rows or TARGET_ROWS
    keys = list(keys)
    base = df.withColumn("_ord", _as_number(df, order).cast("double"))
    lo, hi = F.min("_ord").alias("_lo"), F.max("_ord").alias("_hi")
    hot = hot_groups(base, keys, lo, hi, target_rows=target, at_most=at_most)
    if hot is None:
        return df.withColumn(CHUNK, F.lit(0).cast("long").alias(CHUNK, metadata=_WHOLE))
    if tiebreak:
        tie = _as_number(df, tiebreak, _common_bytes(df, tiebreak)).cast("double")
    else:
        tie = F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields if not _has_map(f.dataType)]).cast("double")
    base = base.withColumn("_tie", tie)
    parts = F.ceil(F.col("_rows") / F.lit(float(target)))
    cells = hot.select(*keys, "_lo", ((F.col("_hi") - F.col("_lo") + 1) / parts).alias("_width"))
    cell = F.floor((F.col("_ord") - F.col("_lo")) / F.col("_width"))
    out = base.join(F.broadcast(cells), keys, "left").withColumn(CHUNK, F.coalesce(cell, F.lit(0)))
    # Only rows of oversized series are looked at again for bursts.
    in_hot = base.join(F.broadcast(cells), keys).withColumn(CHUNK, cell)
    out, in_hot = out.drop("_lo", "_width"), in_hot.drop("_lo", "_width")

    marks = F.array(*[F.lit(i / _CUTS) for i in range(1, _CUTS)])
    largest = None
    while True:
        burst = hot_groups(
            in_hot,
            [*keys, CHUNK],
            lo,
            hi,
            F.percentile_approx("_ord", marks, F.lit(1000)).alias("_at"),
            F.percentile_approx("_tie", marks, F.lit(1000)).alias("_tie_at"),
            target_rows=4 * target,
            limit=_MAX_BURSTS,
        )
        if burst is None:
            break
        before, largest = largest, burst.agg(F.max("_rows")).first()[0]
        if before is not None and largest >= before:
            _log.warning("%d rows of one series share %s and %s and stay in one chunk", largest, order, tiebreak)
            break
        tied = F.col("_hi") == F.col("_lo")
        cuts = burst.select(*keys, CHUNK, tied.alias("_tied"), F.when(tied, F.col("_tie_at")).otherwise(F.col("_at")).alias("_at"))
        out, in_hot = _recut(out, cuts, keys), _recut(in_hot, cuts, keys)
    return out.select(*df.columns, CHUNK)


def is_split(rows: DataFrame) -> bool:
    """False when every series was small enough to stay in one chunk."""
    return not rows.schema[CHUNK].metadata.get("whole", False)


def _recut(rows: DataFrame, cuts: DataFrame, keys: list[str]) -> DataFrame:
    x = F.when(F.col("_tied"), F.col("_tie")).otherwise(F.col("_ord"))
    below = F.size(F.filter("_at", lambda b: b < x))
    at = F.size(F.filter("_at", lambda b: b == x))
    # Values equal to a repeated boundary are crowded: they get the odd number after those below.
    sub = F.coalesce(2 * below + (at > 1).cast("int"), F.lit(0))
    return (
        rows.join(F.broadcast(cuts), [*keys, CHUNK], "left")
        .withColumn(CHUNK, F.col(CHUNK) * (2 * _CUTS) + sub)
        .drop("_at", "_tied")
    )


def carried_chunks(per_chunk: DataFrame, keys: Sequence[str], before: dict[str, Column], after: dict[str, Column]) -> DataFrame:
    """Turn per-chunk summaries into what each chunk receives from earlier and later chunks.

    ``per_chunk`` has one row per ``(keys, _chunk)``; a series has as many chunks as it is large, in
    units of the target size, so these windows are small.
    """
    w = Window.partitionBy(*keys)
    earlier = w.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    later = w.orderBy(F.desc(CHUNK)).rowsBetween(Window.unboundedPreceding, -1)
    return per_chunk.select(
        *keys,
        CHUNK,
        *[c.over(earlier).alias(n) for n, c in before.items()],
        *[c.over(later).alias(n) for n, c in after.items()],
    )


def positions(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    tiebreak: str | None = None,
    key_stats: DataFrame | None = None,
    target_rows: int | None = None,
    at_most: int | None = None,
) -> DataFrame:
    """Add ``_pos`` (0-based place in the series) and ``_n`` (its length), plus ``key_stats`` columns.

    The place is the chunk's starting offset plus the row number inside the chunk.
    """
    rows = split_hot(df, keys, order, tiebreak, target_rows, at_most)
    inside = Window.partitionBy(*keys, CHUNK).orderBy(order, *([tiebreak] if tiebreak else []))
    if not is_split(rows):
        whole = Window.partitionBy(*keys)
        if key_stats is not None:
            rows = rows.join(key_stats, list(keys))
        return rows.withColumn(POS, F.row_number().over(inside).cast("long") - 1).withColumn("_n", F.count("*").over(whole))
    by_chunk = rows.groupBy(*keys, CHUNK).agg(F.count("*").alias("_cnt"))
    w = Window.partitionBy(*keys)
    offsets = by_chunk.select(
        *keys,
        CHUNK,
        F.coalesce(
            F.sum("_cnt").over(w.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_off"),
        F.sum("_cnt").over(w).alias("_n"),
    )
    if key_stats is not None:
        offsets = offsets.join(key_stats, list(keys))
    return (
        rows.join(offsets, [*keys, CHUNK])
        .withColumn(POS, F.col("_off") + F.row_number().over(inside) - 1)
        .drop("_off")
    )


def halo_blocks(df: DataFrame, keys: Sequence[str], back: int, ahead: int, block_rows: int | None = None) -> tuple[DataFrame, Window]:
    """Cut positioned rows into equal blocks, each with ``back``/``ahead`` neighbour rows copied in.

    Frames of up to ``back`` rows behind and ``ahead`` rows in front are then exact for rows with
    ``_home`` true; copies have ``_home`` false and are dropped by the caller after the window.
    """
    size = max(block_rows or TARGET_ROWS, 4 * (back + ahead), 4)
    home = F.floor(F.col(POS) / F.lit(size)).cast("long")
    inside = F.col(POS) % size
    targets = F.array(
        home,
        F.when(inside >= size - back, home + 1),
        F.when((inside < ahead) & (home > 0), home - 1),
    )
    out = df.withColumn("_b", home).withColumn(BLOCK, F.explode(F.array_compact(targets)))
    out = out.withColumn(HOME, F.col(BLOCK) == F.col("_b")).drop("_b")
    return out, Window.partitionBy(*keys, BLOCK).orderBy(POS)


def attach(rows: DataFrame, stats: DataFrame, keys: Sequence[str], target_rows: int | None = None, at_most: int | None = None) -> DataFrame:
    """Join one row of statistics per series onto the rows of that series.

    Spark broadcasts ``stats`` by itself when it is measured to be small. When it is not, rows of an
    oversized series are spread over salts, with one copy of its statistics per salt.
    """
    target = target_rows or TARGET_ROWS
    hot = hot_groups(rows, keys, target_rows=target, at_most=at_most)
    if hot is None:
        return rows.join(stats, list(keys))
    hot = hot.select(*keys, F.ceil(F.col("_rows") / F.lit(float(target))).cast("int").alias("_salts"))
    plain = [f.name for f in rows.schema.fields if not isinstance(f.dataType, (T.MapType, T.StructType, T.ArrayType))]
    salted = rows.join(F.broadcast(hot), list(keys), "left").withColumn(
        "_salt", F.coalesce(F.pmod(F.xxhash64(*plain), F.col("_salts")).cast("int"), F.lit(0))
    )
    copies = stats.join(F.broadcast(hot), list(keys), "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1))
    )
    return salted.drop("_salts").join(copies.drop("_salts"), [*keys, "_salt"]).drop("_salt")
