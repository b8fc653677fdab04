"""Exact quantiles with linear interpolation, for groups of any size.

The built-in ``percentile`` keeps every distinct value of a group in one buffer. That is right for
ordinary groups and wrong for a group with a third of all rows. Oversized groups go another way: a
bounded sketch brackets each wanted rank, everything outside the brackets is only counted, and the few
values inside are ranked exactly.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridspark.plans.skew import hot_groups

# Largest group handed to the built-in percentile. A hash-aggregating task holds at most 128 groups
# at once before it turns to sorting, which bounds its buffers.
BUILTIN_ROWS = 200_000
# Sketch accuracy: ranks are off by at most rows / accuracy. It grows with the largest group, so that
# about 4 * RANKED_ROWS values are left to rank however large the group is.
ACCURACY, MAX_ACCURACY = 10_000, 200_000
RANKED_ROWS = 100_000
# Size of the sketch where whole columns are summed up side by side (three numbers of 8 bytes for each unit at most), and the rank error
# that this size is good for in nearly all cases; a bracket that misses its rank is made WIDER times as wide.
WIDE_SKETCH, WIDE_ERROR = 8192, 0.001
WIDER = 8


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Mapping[str, float],
    aggs: Sequence[Column] = (),
    builtin_rows: int | None = None,
    accuracy: int = ACCURACY,
    at_most: int | None = None,
) -> DataFrame:
    """One row per group with a column per entry of ``probs`` (name -> probability).

    Nulls and NaN are ignored. Further aggregates of the same rows go in ``aggs`` and share the pass.
    Groups without any value have null quantiles. ``keys`` must not be empty (use
    :func:`gridspark.plans.keyed`).
    """
    # The bracket argument below needs groups of at least 2 * accuracy rows.
    limit = max(builtin_rows or BUILTIN_ROWS, 2 * accuracy)
    keys = list(keys)
    v = F.col(value).cast("double")
    v = F.when(~F.isnan(v), v)
    rows = df.select(*keys, v.alias("_v")).where(F.col("_v").isNotNull())
    hot = hot_groups(rows, keys, target_rows=limit, at_most=at_most)
    plist = F.array(*[F.lit(float(p)) for p in probs.values()])
    quantiles = [F.col("_q")[i].alias(n) for i, n in enumerate(probs)]
    if hot is None:
        out = df.groupBy(*keys).agg(F.percentile(v, plist).alias("_q"), *aggs)
        return out.select("*", *quantiles).drop("_q")
    largest = hot.agg(F.max("_rows")).first()[0]
    accuracy = max(accuracy, min(MAX_ACCURACY, largest // RANKED_ROWS))
    hot = F.broadcast(hot.where(F.col("_rows") > 2 * accuracy).select(*keys))
    small = rows.join(hot, keys, "left_anti").groupBy(*keys).agg(F.percentile("_v", plist).alias("_q")).select(*keys, *quantiles)
    found = small.unionByName(_bracketed(rows, hot, keys, probs, accuracy))
    every = df.groupBy(*keys).agg(F.count("*").alias("_rows"), *aggs).drop("_rows")
    return every.join(found, keys, "left")


def _bracketed(rows: DataFrame, hot: DataFrame, keys: list[str], probs: Mapping[str, float], accuracy: int) -> DataFrame:
    # A sketch value for p -/+ 2/accuracy is off by at most 1/accuracy, so its rank is at least
    # rows/accuracy >= 2 away from the wanted order statistics, on the right side of them.
    margin = 2.0 / accuracy
    ends = []
    for p in probs.values():
        ends += [max(0.0, p - margin), min(1.0, p + margin)]
    # One sketch row per oversized group: bounded like the list of those groups.
    sketch = rows.join(hot, keys).groupBy(*keys).agg(
        F.count("*").alias("_n"),
        F.percentile_approx("_v", F.array(*[F.lit(e) for e in ends]), F.lit(accuracy)).alias("_ends"),
    )
    v = F.col("_v")
    lows = [F.col("_ends")[2 * i] for i in range(len(probs))]
    highs = [F.col("_ends")[2 * i + 1] for i in range(len(probs))]
    wanted = _any([(v >= lo) & (v <= hi) for lo, hi in zip(lows, highs)])
    # Slots ascend with the value, so all of slot s sorts before slot s + 1. A slot lies wholly inside or
    # wholly outside the brackets; outside, its rows are counted under one null.
    slot: Column = F.lit(0)
    for lo, hi in zip(lows, highs):
        slot = slot + (v >= lo).cast("int") + (v > hi).cast("int")
    counted = (
        rows.join(F.broadcast(sketch), keys)
        .select(*keys, "_n", F.coalesce(slot, F.lit(0)).alias("_slot"), F.when(wanted, v).alias("_c"))
        .groupBy(*keys, "_n", "_slot", "_c")
        .agg(F.count("*").alias("_k"))
    )
    by_slot = Window.partitionBy(*keys).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        counted.groupBy(*keys, "_slot")
        .agg(F.sum("_k").alias("_slot_rows"))
        .select(*keys, "_slot", F.coalesce(F.sum("_slot_rows").over(by_slot), F.lit(0)).alias("_start"))
    )
    in_slot = Window.partitionBy(*keys, "_slot").orderBy("_c").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (
        counted.join(starts, [*keys, "_slot"])
        .withColumn("_end", F.col("_start") + F.sum("_k").over(in_slot))
        .withColumn("_first", F.col("_end") - F.col("_k"))
    )
    picks = []
    for i, p in enumerate(probs.values()):
        h = (F.col("_n") - 1) * F.lit(float(p))
        for name, rank in (("lo", F.floor(h)), ("hi", F.ceil(h))):
            hit = (F.col("_first") <= rank) & (rank < F.col("_end"))
            picks.append(F.max(F.when(hit, F.col("_c"))).alias(f"_{name}{i}"))
    out = ranked.groupBy(*keys, "_n").agg(*picks)
    return out.select(*keys, *_interpolated(probs, str(keys)))


def wide_quantiles(
    df: DataFrame,
    values: Mapping[str, Column],
    probs: Mapping[str, float],
    aggs: Callable[[Column], Mapping[str, Column]],
    builtin_rows: int | None = None,
    error: float = WIDE_ERROR,
) -> DataFrame:
    """One row per entry of ``values``: ``column``, its ``aggs`` and exact quantiles over all rows.

    The columns stay side by side. A first pass, run when the plan is built, takes the aggregates and a mergeable
    sketch of each column (one row comes back). Columns with few values then use the built-in percentile. The sketches
    of the others bracket each rank; a count below and inside the brackets (again one row) tells which hold it, those
    that do not are widened and counted again. Only values inside brackets leave the last pass, counted by value.
    """
    limit = builtin_rows or BUILTIN_ROWS
    names = list(values)
    plain = {c: F.when(~F.isnan(v), v) for c, v in values.items()}
    sketch = lambda v: F.kll_sketch_agg_double(v, F.lit(WIDE_SKETCH))
    first = [F.struct(*[a.alias(n) for n, a in aggs(values[c]).items()], F.count(plain[c]).alias("_n"), F.min(plain[c]).alias("_min"), F.max(plain[c]).alias("_max"), sketch(plain[c]).alias("_sketch")).alias(f"_{i}") for i, c in enumerate(names)]
    known = df.agg(*first)
    row = known.first()
    fields = [f for f in known.schema["_0"].dataType.fields if f.name not in ("_n", "_min", "_max", "_sketch")]
    out = [f.name for f in fields]
    plist = list(probs.values())
    heads = {c: [F.lit(c).alias("column"), *[F.lit(row[i][f.name]).cast(f.dataType).alias(f.name) for f in fields]] for i, c in enumerate(names)}
    few = [c for i, c in enumerate(names) if row[i]["_n"] <= limit]
    many = {c: row[i] for i, c in enumerate(names) if row[i]["_n"] > limit}
    parts = []
    if few:
        once = df.agg(*[F.percentile(plain[c], F.array(*map(F.lit, plist))).alias(f"_{k}") for k, c in enumerate(few)])
        cells = [F.struct(*heads[c], F.col(f"_{k}").alias("_q")) for k, c in enumerate(few)]
        rows = once.select(F.explode(F.array(*cells)).alias("_s")).select("_s.*")
        parts.append(rows.select("column", *out, *[F.col("_q")[k].alias(n) for k, n in enumerate(probs)]))
    if many:
        brackets = _brackets(df, plain, many, plist, error)
        # Where both ends of a bracket are the same value, that is the quantile; values of the others are ranked.
        open_ones = {at: ends for at, ends in brackets.items() if ends[0] < ends[1]}
        cells = [
            F.struct(*heads[c], F.lit(r["_n"]).alias("_n"), F.array(*[F.lit(None if (c, k) in open_ones else brackets[c, k][0]).cast("double") for k in range(len(plist))]).alias("_known"))
            for c, r in many.items()
        ]
        # One row per column.
        known = df.sparkSession.range(1).select(F.explode(F.array(*cells)).alias("_s")).select("_s.*")
        picks = [(k, name, rank((F.col("_n") - 1) * F.lit(float(p)))) for k, p in enumerate(plist) for name, rank in (("lo", F.floor), ("hi", F.ceil))]
        if open_ones:
            inside = [F.when(plain[c].between(low, high), F.struct(F.lit(c).alias("column"), F.lit(k).alias("_p"), plain[c].alias("_c"))) for (c, k), (low, high, _) in open_ones.items()]
            # Most rows lie in no bracket: they are left out before anything is put together for them.
            near = _any([plain[c].between(low, high) for (c, _), (low, high, _) in open_ones.items()])
            counted = df.where(near).select(F.explode(F.array_compact(F.array(*inside))).alias("_s")).select("_s.*").groupBy("column", "_p", "_c").agg(F.count("*").alias("_k"))
            below = df.sparkSession.createDataFrame([(c, k, below) for (c, k), (_, _, below) in open_ones.items()], "column string, _p int, _below long")
            rows_of = df.sparkSession.createDataFrame([(c, r["_n"]) for c, r in many.items()], "column string, _n long")
            w = Window.partitionBy("column", "_p").orderBy("_c").rowsBetween(Window.unboundedPreceding, 0)
            ranked = counted.withColumn("_end", F.sum("_k").over(w)).join(F.broadcast(below), ["column", "_p"]).join(F.broadcast(rows_of), "column")
            ranked = ranked.withColumn("_end", F.col("_end") + F.col("_below")).withColumn("_first", F.col("_end") - F.col("_k"))
            found = [F.max(F.when((F.col("_p") == k) & (F.col("_first") <= at) & (at < F.col("_end")), F.col("_c"))).alias(f"_found_{name}{k}") for k, name, at in picks]
            known = known.join(ranked.groupBy("column").agg(*found), "column", "left")
        else:
            known = known.withColumns({f"_found_{name}{k}": F.lit(None).cast("double") for k, name, _ in picks})
        known = known.withColumns({f"_{name}{k}": F.coalesce(F.get("_known", F.lit(k)), F.col(f"_found_{name}{k}")) for k, name, _ in picks})
        parts.append(known.select("column", *out, *_interpolated(probs, "a column")))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _brackets(df: DataFrame, plain: Mapping[str, Column], many: Mapping, plist: list[float], error: float) -> dict[tuple[str, int], tuple[float, float, int]]:
    """(low, high, rows below low) for each column and probability, so that the wanted order statistics lie in [low, high]."""
    spark = df.sparkSession
    found, margins = {}, {(c, k): error for c in many for k in range(len(plist))}
    while margins:
        ends = {}
        for (c, k), margin in margins.items():
            ranks = [plist[k] - margin, plist[k] + margin]
            ends[c, k] = [F.lit(many[c]["_min"]) if ranks[0] <= 0 else F.kll_sketch_get_quantile_double(F.lit(many[c]["_sketch"]), F.lit(ranks[0])), F.lit(many[c]["_max"]) if ranks[1] >= 1 else F.kll_sketch_get_quantile_double(F.lit(many[c]["_sketch"]), F.lit(ranks[1]))]
        ends = dict(zip(ends, spark.range(1).select(*[F.array(*e) for e in ends.values()]).first()))
        counts = df.agg(*[F.array(F.count_if(plain[c] < low), F.count_if(plain[c] <= high)) for (c, _), (low, high) in ends.items()]).first()
        missed = {}
        for (c, k), (low, high), (below, up_to) in zip(ends, ends.values(), counts):
            h = (many[c]["_n"] - 1) * plist[k]
            if below <= math.floor(h) and math.ceil(h) < up_to:
                found[c, k] = (low, high, below)
            else:
                missed[c, k] = margins[c, k] * WIDER
        margins = missed
    return found


def _interpolated(probs: Mapping[str, float], of: str) -> list[Column]:
    """Quantiles from the order statistics ``_lo<i>`` and ``_hi<i>`` around them, by the formula of the built-in percentile."""
    cols = []
    for i, (name, p) in enumerate(probs.items()):
        h = (F.col("_n") - 1) * F.lit(float(p))
        lo, hi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        between = F.when(lo == hi, lo).otherwise((F.ceil(h) - h) * lo + (h - F.floor(h)) * hi)
        missed = F.raise_error(F.lit(f"the sketch brackets missed the {p} quantile of {of}; raise accuracy")).cast("double")
        cols.append(F.when(lo.isNull() | hi.isNull(), missed).otherwise(between).alias(name))
    return cols


def _any(conds: list[Column]) -> Column:
    out = conds[0]
    for c in conds[1:]:
        out = out | c
    return out
