"""Distribution, seasonality, autocorrelation and peak statistics, one result per series."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridspark.functions.timeparts import micros
from gridspark.plans import CHUNK, attach, exact_quantiles, halo_blocks, is_split, keyed, positions, sized, unkeyed
from gridspark.plans.skew import BLOCK, HOME, POS
from gridspark.sources.staging import staged

# Reported percentiles.
_PERCENTILES = {"p10": 0.10, "p25": 0.25, "p50": 0.50, "p75": 0.75, "p90": 0.90, "p95": 0.95, "p99": 0.99}
# Seasonal units per period (weekday 0 is Monday).
_UNITS = {"daily": F.hour, "weekly": F.weekday, "annual": F.month}


def describe_timeseries(df: DataFrame, keys: Sequence[str] = (), ts: str | None = "ts", value: str = "value") -> DataFrame:
    """Distribution of the finite values, with seasonal hints when there is a time column.

    Skewness and kurtosis divide population moments by the sample standard deviation. Results that need
    more points than there are come back null.
    """
    asked = keys
    df, keys = keyed(df, keys)
    v = F.col(value)
    whole = F.when(~F.isnan(v) & (F.abs(v) != float("inf")), v)
    rows = df.select(*keys, *([ts] if ts else []), whole.alias("_x"), (v.isNotNull() & ~F.isnan(v)).alias("_given"))
    n = F.count("_x")
    scale = (n - 1) / F.nullif(n, F.lit(0))
    std = F.stddev_samp("_x")
    flat = std == 0
    excluded = F.sum((F.col("_given") & F.col("_x").isNull()).cast("long"))
    shape = [
        n.alias("count"),
        F.avg("_x").alias("mean"),
        std.alias("std"),
        F.min("_x").alias("min"),
        F.max("_x").alias("max"),
        F.when(n >= 3, F.when(flat, 0.0).otherwise(F.skewness("_x") * F.pow(scale, F.lit(1.5)))).alias("skewness"),
        F.when(n >= 4, F.when(flat, 0.0).otherwise((F.kurtosis("_x") + 3) * scale * scale - 3)).alias("kurtosis"),
        excluded.alias("excluded_non_finite_count"),
    ]
    out = exact_quantiles(rows, keys, "_x", _PERCENTILES, shape)
    out = out.withColumn("median", F.col("p50")).withColumn("has_non_finite_values", F.col("excluded_non_finite_count") > 0)
    if ts:
        out = out.join(_hints(rows.where(F.col("_x").isNotNull()), keys, ts), keys, "left")
    return unkeyed(out, asked)


def seasonal_hints(df: DataFrame, keys: Sequence[str] = (), ts: str = "ts", value: str = "value") -> DataFrame:
    """Variation of hourly and weekday means; null where there are too few points or units."""
    asked = keys
    df, keys = keyed(df, keys)
    return unkeyed(_hints(df.where(F.col(value).isNotNull()).select(*keys, ts, F.col(value).alias("_x")), keys, ts), asked)


def _hints(rows: DataFrame, keys: list[str], ts: str) -> DataFrame:
    def variation(unit: Column, rows_needed: int, units_needed: int, limit: float, name: str) -> DataFrame:
        means = rows.groupBy(*keys, unit.alias("_u")).agg(F.avg("_x").alias("_m"), F.count("*").alias("_k"))
        mean = F.avg("_m")
        cv = F.when(mean == 0, 0.0).otherwise(F.stddev_samp("_m") / F.nullif(mean, F.lit(0.0)))
        enough = (F.sum("_k") >= rows_needed) & (F.count("*") >= units_needed)
        out = means.groupBy(*keys).agg(F.when(enough, cv).alias(f"{name}_variation_cv"))
        return out.withColumn(f"has_{name}_pattern", F.col(f"{name}_variation_cv") > limit)

    daily = variation(F.hour(ts), 48, 12, 0.05, "daily")
    weekly = variation(F.weekday(ts), 336, 5, 0.03, "weekly")
    return daily.join(weekly, keys)


def autocorrelation(
    df: DataFrame,
    keys: Sequence[str] = (),
    ts: str = "ts",
    value: str = "value",
    lags: int = 48,
    tiebreak: str | None = None,
    target_rows: int | None = None,
) -> DataFrame:
    """``(keys..., lag, autocorrelation)`` by place in the series, for lags up to its length."""
    asked = keys
    df, keys = keyed(df, keys)
    pick = list(dict.fromkeys([*keys, ts, value, *([tiebreak] if tiebreak else [])]))
    rows = df.where(F.col(value).isNotNull()).select(*pick)
    stats = rows.groupBy(*keys).agg(F.avg(value).alias("_mean"), F.var_samp(value).alias("_var"))
    rows = positions(rows, keys, ts, tiebreak, stats, target_rows)
    rows, _ = halo_blocks(rows, keys, lags, 0, target_rows)
    rows = rows.select(*keys, BLOCK, POS, HOME, (F.col(value) - F.col("_mean")).alias("_d"), "_n", "_var")
    key_fields = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys)

    def products(pdf: pd.DataFrame) -> pd.DataFrame:
        """Sum of products with the row ``k`` before, over the block's own rows, for every lag."""
        pdf = pdf.sort_values(POS)
        d, own = pdf["_d"].to_numpy(), int((~pdf[HOME]).sum())
        sums = [float(np.dot(d[max(own, k) :], d[max(own, k) - k : len(d) - k])) for k in range(min(lags, len(d) - 1) + 1)]
        head = pdf[[*keys, "_n", "_var"]].iloc[[0] * len(sums)].reset_index(drop=True)
        return head.assign(lag=range(len(sums)), _s=sums)

    parts = rows.groupBy(*keys, BLOCK).applyInPandas(products, f"{key_fields}, _n long, _var double, lag long, _s double")
    r = F.col("_s") / F.col("_n") / F.nullif(F.col("_var"), F.lit(0.0))
    return unkeyed(
        parts.groupBy(*keys, "_n", "_var", "lag")
        .agg(F.sum("_s").alias("_s"))
        .where(F.col("lag") < F.col("_n"))
        .select(*keys, "lag", F.when((F.col("lag") == 0) | (F.col("_var") == 0), 1.0).otherwise(r).alias("autocorrelation")),
        asked,
    )


def seasonal_pattern(df: DataFrame, period: str = "daily", keys: Sequence[str] = (), ts: str = "ts", value: str = "value") -> DataFrame:
    """``(keys..., unit, mean, std, min, max)`` by hour of day, weekday or month."""
    if period not in _UNITS:
        raise ValueError(f"period {period!r} is none of ('daily', 'weekly', 'annual')")
    return (
        df.where(F.col(value).isNotNull() & F.col(ts).isNotNull())
        .dropna(subset=list(keys) or [ts])
        .groupBy(*keys, _UNITS[period](ts).alias("unit"))
        .agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"), F.min(value).alias("min"), F.max(value).alias("max"))
    )


def seasonal_summary(df: DataFrame, period: str = "daily", keys: Sequence[str] = (), ts: str = "ts", value: str = "value") -> DataFrame:
    """Unit with the highest mean (the first on ties) and the ratio of highest to lowest mean."""
    low, high = F.min("mean"), F.max("mean")
    ratio = F.when(low != 0, high / F.nullif(low, F.lit(0.0))).when(high != 0, float("inf")).otherwise(1.0)
    return (
        seasonal_pattern(df, period, keys, ts, value)
        .groupBy(*keys)
        .agg(F.max_by("unit", F.struct("mean", -F.col("unit"))).alias("dominant_unit"), ratio.alias("range_ratio"))
        .withColumn("period", F.lit(period))
    )


def quantile_bands(df: DataFrame, keys: Sequence[str] = (), ts: str = "ts", value: str = "value") -> DataFrame:
    """Quartiles and mean by hour of day."""
    rows = df.select(*keys, F.hour(ts).alias("hour"), value).dropna(subset=[*keys, "hour"])
    return exact_quantiles(rows, [*keys, "hour"], value, {"q25": 0.25, "q75": 0.75}, [F.avg(value).alias("mean")])


def peak_analysis(
    df: DataFrame,
    threshold_percentile: float = 90.0,
    keys: Sequence[str] = (),
    ts: str = "ts",
    value: str = "value",
    tiebreak: str | None = None,
    target_rows: int | None = None,
) -> DataFrame:
    """Peak and trough, time above a percentile, usual peak hours / weekdays / months, longest run."""
    asked = keys
    df, keys = keyed(df, keys)
    v = F.col(value)
    ratio = F.when(F.col("trough_value") != 0, F.col("peak_value") / F.nullif(F.col("trough_value"), F.lit(0.0)))
    load = F.when(F.col("peak_value") != 0, F.col("_mean") / F.nullif(F.col("peak_value"), F.lit(0.0)))
    df, at_most = sized(df, keys)
    extremes = [
        F.max(value).alias("peak_value"),
        F.max_by(ts, F.when(v.isNotNull(), F.struct(v, -micros(ts)))).alias("peak_timestamp"),
        F.min(value).alias("trough_value"),
        F.min_by(ts, F.when(v.isNotNull(), F.struct(v, micros(ts)))).alias("trough_timestamp"),
        F.avg(value).alias("_mean"),
        F.count(value).alias("_n"),
    ]
    wanted = {"threshold_value": threshold_percentile / 100.0}
    # One row per series, used several times below.
    found = staged(exact_quantiles(df, keys, value, wanted, extremes, at_most=at_most), "peaks")
    threshold = found.select(*keys, "threshold_value")
    base = (
        found.withColumn("peak_to_trough_ratio", ratio.when(F.col("peak_value") != 0, float("inf")).when(F.col("peak_value") == 0, 1.0))
        .withColumn("mean_to_peak_ratio", load.when(F.col("_mean") == 0, 1.0).when(F.col("_mean").isNotNull(), float("inf")))
        .withColumn("threshold_percentile", F.lit(float(threshold_percentile)))
    )
    above = attach(df.where(v.isNotNull()).select(*keys, ts, value), threshold, keys, target_rows, at_most).where(v > F.col("threshold_value"))
    parts = F.explode(
        F.array(
            F.struct(F.lit("peak_hours").alias("kind"), F.hour(ts).alias("unit")),
            F.struct(F.lit("peak_days").alias("kind"), F.weekday(ts).alias("unit")),
            F.struct(F.lit("peak_months").alias("kind"), F.month(ts).alias("unit")),
        )
    )
    counts = above.select(*keys, parts.alias("_p")).groupBy(*keys, "_p.kind", "_p.unit").agg(F.count("*").alias("_c"))
    rank = F.row_number().over(Window.partitionBy(*keys, "kind").orderBy(F.desc("_c"), "unit"))

    def picked(kind: str) -> Column:
        ranked = F.sort_array(F.collect_list(F.when((F.col("kind") == kind) & (F.col("_r") <= 3), F.struct("_r", "unit"))))
        return F.transform(ranked, lambda x: x["unit"]).alias(kind)

    # At most three entries per kind are left to list.
    # Every row above the threshold has one weekday.
    timing = (
        counts.withColumn("_r", rank)
        .groupBy(*keys)
        .agg(*[picked(k) for k in ("peak_hours", "peak_days", "peak_months")], F.sum(F.when(F.col("kind") == "peak_days", F.col("_c"))).alias("_above"))
    )
    runs = longest_run(df, threshold, "threshold_value", keys, ts, value, tiebreak, target_rows, at_most)
    empty = F.array().cast("array<int>")
    return unkeyed(
        base.join(timing, keys, "left")
        .join(runs, keys, "left")
        .withColumn("time_above_threshold_pct", F.coalesce(100.0 * F.col("_above") / F.nullif(F.col("_n"), F.lit(0)), F.lit(0.0)))
        .withColumns({k: F.coalesce(F.col(k), empty) for k in ("peak_hours", "peak_days", "peak_months")})
        .withColumn("max_consecutive_above_threshold", F.coalesce("longest_run", F.lit(0).cast("long")))
        .drop("_mean", "_n", "_above", "longest_run"),
        asked,
    )


def longest_run(
    df: DataFrame,
    thresholds: DataFrame,
    threshold: str,
    keys: Sequence[str],
    ts: str = "ts",
    value: str = "value",
    tiebreak: str | None = None,
    target_rows: int | None = None,
    at_most: int | None = None,
) -> DataFrame:
    """Longest stretch of consecutive filled points above each series' threshold."""
    keys = list(keys)
    pick = list(dict.fromkeys([*keys, ts, value, *([tiebreak] if tiebreak else [])]))
    rows = positions(df.where(F.col(value).isNotNull()).select(*pick), keys, ts, tiebreak, thresholds, target_rows, at_most)
    number = F.row_number().over(Window.partitionBy(*keys, CHUNK).orderBy(POS))
    runs = (
        rows.where(F.col(value) > F.col(threshold))
        .withColumn("_run", F.col(POS) - number)
        .groupBy(*keys, CHUNK, "_run")
        .agg(F.count("*").alias("_len"), F.min(POS).alias("_from"), F.max(POS).alias("_to"))
    )
    if not is_split(rows):
        return runs.groupBy(*keys).agg(F.max("_len").alias("longest_run"))
    ends = rows.groupBy(*keys, CHUNK).agg(F.min(POS).alias("_lo"), F.max(POS).alias("_hi"))
    runs = runs.join(ends, [*keys, CHUNK])
    # Only runs at a chunk border can continue in the next chunk: at most two per chunk.
    w = Window.partitionBy(*keys).orderBy("_from")
    border = runs.where((F.col("_from") == F.col("_lo")) | (F.col("_to") == F.col("_hi")))
    starts = F.coalesce((F.lag("_to").over(w) + 1 != F.col("_from")).cast("int"), F.lit(1))
    joined = (
        border.withColumn("_new", starts)
        .withColumn("_id", F.sum("_new").over(w))
        .groupBy(*keys, "_id")
        .agg(F.sum("_len").alias("_len"))
    )
    every = runs.select(*keys, "_len").unionByName(joined.select(*keys, "_len"))
    return every.groupBy(*keys).agg(F.max("_len").alias("longest_run"))
