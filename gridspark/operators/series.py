"""Building and aligning series: ``(keys..., ts, value)`` frames with many series each.

A row with a null key belongs to no series; operators drop it, as a grouping by key does.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridspark.functions.scalars import finite
from gridspark.functions.timeparts import duration_micros, from_micros, micros, truncate
from gridspark.plans import CHUNK, carried_chunks, is_split, keyed, split_hot, unkeyed, unsized

# Grid points made from one row at a time.
_STRIDE = 4096


def to_series(
    df: DataFrame,
    keys: Sequence[str] = (),
    timestamp_field: str = "timestamp",
    value_field: str | None = None,
    value_fields: Sequence[str] | None = None,
) -> DataFrame:
    """Project records to ``(keys..., ts, value)`` or, for several fields, ``(keys..., ts, fields...)``.

    Unreadable times and numbers become null, as do NaN and infinities.
    """
    fields = [value_field] if value_field else list(value_fields or [])
    if not fields:
        skip = {*keys, timestamp_field}
        fields = [f.name for f in df.schema.fields if f.name not in skip and isinstance(f.dataType, T.NumericType)]
    for name in [*keys, timestamp_field, *fields]:
        if name not in df.columns:
            raise ValueError(f"no column {name!r} among {df.columns}")
    ts = F.col(timestamp_field)
    if isinstance(df.schema[timestamp_field].dataType, T.StringType):
        ts = F.try_to_timestamp(ts)
    names = ["value"] if value_field else fields
    values = [finite(F.col(f).try_cast("double")).alias(n) for f, n in zip(fields, names)]
    return df.select(*keys, ts.alias("ts"), *values)


def align(left: DataFrame, right: DataFrame, keys: Sequence[str] = (), ts: str = "ts", names: tuple[str, str] = ("left", "right"), value: str = "value") -> DataFrame:
    """Inner join of two series on time; rows where either value is null are left out."""
    on = [*keys, ts]
    a = left.where(F.col(value).isNotNull()).select(*on, F.col(value).alias(names[0]))
    b = right.where(F.col(value).isNotNull()).select(*on, F.col(value).alias(names[1]))
    return a.join(b, on)


def join_features(df: DataFrame, features: DataFrame, keys: Sequence[str] = (), ts: str = "ts", on: Sequence[str] | None = None, tiebreak: str | None = None, target_rows: int | None = None) -> DataFrame:
    """Left join feature columns on time, then carry their last value forward over misses."""
    on = list(on or [*keys, ts])
    columns = [c for c in features.columns if c not in on]
    return carry_forward(df.join(features, on, "left"), columns, keys, ts, tiebreak, target_rows)


def carry_forward(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), ts: str = "ts", tiebreak: str | None = None, target_rows: int | None = None) -> DataFrame:
    """Replace nulls by the last value before them in the series."""
    names = df.columns
    rows, keys = keyed(df, keys)
    rows = split_hot(rows, keys, ts, tiebreak, target_rows)
    order = [ts, *([tiebreak] if tiebreak else [])]
    if is_split(rows):
        at = F.struct(*order)
        lasts = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), at)).alias(c) for c in columns]
        per_chunk = rows.groupBy(*keys, CHUNK).agg(*lasts)
        carried = carried_chunks(per_chunk, keys, {f"_in_{c}": F.last(c, ignorenulls=True) for c in columns}, {})
        rows = rows.join(carried, [*keys, CHUNK])
    else:
        rows = rows.withColumns({f"_in_{c}": F.lit(None).cast(rows.schema[c].dataType) for c in columns})
    w = Window.partitionBy(*keys, CHUNK).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    filled = {c: F.coalesce(F.last(c, ignorenulls=True).over(w), F.col(f"_in_{c}")) for c in columns}
    return rows.withColumns(filled).select(*names)


def neighbours(df: DataFrame, keys: Sequence[str], ts: str, value: str, tiebreak: str | None = None, target_rows: int | None = None, at_most: int | None = None) -> DataFrame:
    """Add ``_prev`` / ``_next``: time and value of the nearest filled points at or around each row."""
    rows = split_hot(df, keys, ts, tiebreak, target_rows, at_most)
    order = [ts, *([tiebreak] if tiebreak else [])]
    point = F.when(F.col(value).isNotNull(), F.struct(*order, F.col(value).alias("_v")))
    rows = rows.withColumn("_point", point)
    part = Window.partitionBy(*keys, CHUNK)
    back = part.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    # Descending order keeps "next value" a running frame instead of a rescan per row.
    fore = part.orderBy(*[F.desc(c) for c in order]).rowsBetween(Window.unboundedPreceding, 0)
    prev, nxt = F.last("_point", ignorenulls=True).over(back), F.last("_point", ignorenulls=True).over(fore)
    if is_split(rows):
        per_chunk = rows.groupBy(*keys, CHUNK).agg(F.max("_point").alias("_last"), F.min("_point").alias("_first"))
        carried = carried_chunks(
            per_chunk,
            keys,
            {"_from": F.last("_last", ignorenulls=True)},
            {"_to": F.last("_first", ignorenulls=True)},
        )
        rows = rows.join(carried, [*keys, CHUNK])
        prev, nxt = F.coalesce(prev, F.col("_from")), F.coalesce(nxt, F.col("_to"))
        return rows.withColumn("_prev", prev).withColumn("_next", nxt).drop("_point", "_from", "_to", CHUNK)
    return rows.withColumn("_prev", prev).withColumn("_next", nxt).drop("_point", CHUNK)


def previous_time(df: DataFrame, keys: Sequence[str], ts: str, filled: Column | None = None, target_rows: int | None = None, at_most: int | None = None) -> DataFrame:
    """Add ``_before``: the time of the last row before in the series, of those that are ``filled`` if given."""
    rows = split_hot(df, keys, ts, None, target_rows, at_most)
    seen = F.col(ts) if filled is None else F.when(filled, F.col(ts))
    w = Window.partitionBy(*keys, CHUNK).orderBy(ts).rowsBetween(Window.unboundedPreceding, -1)
    before = F.last(seen, ignorenulls=True).over(w)
    if is_split(rows):
        per_chunk = rows.groupBy(*keys, CHUNK).agg(F.max(seen).alias("_max"))
        rows = rows.join(carried_chunks(per_chunk, keys, {"_from": F.last("_max", ignorenulls=True)}, {}), [*keys, CHUNK])
        return rows.withColumn("_before", F.coalesce(before, F.col("_from"))).drop("_from", CHUNK)
    return rows.withColumn("_before", before).drop(CHUNK)


def time_grid(df: DataFrame, keys: Sequence[str], ts: str, every: str, anchor: str = "first") -> DataFrame:
    """Every grid time between the first and last time of each series.

    ``anchor="first"`` counts from the first time, ``"floor"`` from the multiple of ``every`` below it.
    The number of grid points is set by the calendar, not by the number of rows.
    """
    step = duration_micros(every)
    start = F.min(micros(ts))
    # A grid may have more rows than the series it is made for.
    bounds = unsized(df, keys).where(F.col(ts).isNotNull()).groupBy(*keys).agg(start.alias("_lo"), F.max(micros(ts)).alias("_hi"))
    if anchor == "floor":
        bounds = bounds.withColumn("_lo", F.col("_lo") - F.pmod(F.col("_lo"), F.lit(step)))
    last = F.floor((F.col("_hi") - F.col("_lo")) / F.lit(step)).cast("long")
    # The strides of a long series go to all tasks; a number of partitions keeps them from being merged again.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        bounds.withColumn("_last", last)
        .withColumn("_s", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_last"), F.lit(_STRIDE).cast("long"))))
        .repartition(tasks, *keys, "_s")
        .withColumn("_i", F.explode(F.sequence(F.col("_s"), F.least(F.col("_s") + (_STRIDE - 1), F.col("_last")))))
        .select(*keys, from_micros(F.col("_lo") + F.col("_i") * step, df, ts).alias(ts))
    )


def regular_grid(df: DataFrame, keys: Sequence[str] = (), ts: str = "ts", value: str = "value", every: str = "30min", anchor: str = "first") -> DataFrame:
    """Sum duplicates of a time, then show the series on a complete grid with nulls where it has no row."""
    asked = keys
    df, keys = keyed(df, keys)
    summed = df.where(F.col(ts).isNotNull()).groupBy(*keys, ts).agg(F.coalesce(F.sum(value), F.lit(0.0)).alias(value), F.count("*").alias("_c"), F.count(value).alias("_f"))
    # A time that occurs once keeps its null; only real duplicates follow the sum rule.
    summed = summed.withColumn(value, F.when((F.col("_c") > 1) | (F.col("_f") > 0), F.col(value))).drop("_c", "_f")
    return unkeyed(time_grid(df, keys, ts, every, anchor).join(summed, [*keys, ts], "left"), asked)


def resample(df: DataFrame, unit: str, keys: Sequence[str] = (), ts: str = "ts", value: str = "value") -> DataFrame:
    """Calendar buckets with mean, min, max, sum and count; buckets without rows are kept (sum and count 0)."""
    asked = keys
    df, keys = keyed(df, keys)
    bucket = truncate(ts, unit, df, ts)
    stats = (
        df.where(F.col(ts).isNotNull())
        .groupBy(*keys, bucket.alias(ts))
        .agg(F.avg(value).alias("mean"), F.min(value).alias("min"), F.max(value).alias("max"), F.sum(value).alias("sum"), F.count(value).alias("count"))
    )
    steps = F.sequence(F.col("_lo"), F.col("_hi"), F.expr(f"interval 1 {unit}"))
    grid = (
        stats.groupBy(*keys).agg(F.min(ts).alias("_lo"), F.max(ts).alias("_hi")).select(*keys, F.explode(steps).alias(ts))
    )
    full = grid.join(stats, [*keys, ts], "left")
    return unkeyed(full.withColumn("sum", F.coalesce("sum", F.lit(0.0))).withColumn("count", F.coalesce("count", F.lit(0))), asked)


def total_by_time(df: DataFrame, ts: str = "ts", value: str = "value", min_count: int = 0, keys: Sequence[str] = ()) -> DataFrame:
    """Total over all units per time. ``min_count=0``: all-null gives 0; ``1``: all-null gives null."""
    total: Column = F.sum(value)
    if min_count == 0:
        total = F.coalesce(total, F.lit(0.0))
    return df.groupBy(*keys, ts).agg(total.alias(value))
