"""Gradient boosting of regression trees for many series at once, on histograms.

Features become bins at each series' own quantiles. A series of ordinary size is fitted by one task, all series side by
side in one job. A series above LARGE_ROWS is never brought together: one grouped sum over (series, node, feature, bin)
gives the histograms of all its nodes on a level, splits follow from running sums over the bins, and what moves is
histograms and splits. Both ways take the same splits: the largest gain, then the first feature, then the lowest bin.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridspark.plans import attach
from gridspark.sources.staging import staged

#: Rows of a series that one task fits.
LARGE_ROWS = 500_000
#: Splits of large series are broadcast up to so many rows, otherwise Spark joins them as it sees fit.
BROADCAST_SPLITS = 100_000
_LEAST_GAIN = 1e-9


def fit_predict(
    rows: DataFrame,
    keys: Sequence[str],
    features: Sequence[str],
    label: str,
    train: str,
    rounds: int = 100,
    depth: int = 6,
    rate: float = 0.1,
    bins: int = 32,
    leaf_rows: int = 5,
    large_rows: int = LARGE_ROWS,
) -> DataFrame:
    """``rows`` with a ``forecast``: for every series a model of its rows where the column ``train`` is true.

    Rows with a null key, feature or label (of a training row) must be gone. A series without training rows has null forecasts.
    """
    keys = list(keys)
    probs = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    edges = rows.where(train).groupBy(*keys).agg(
        F.count("*").alias("_n"),
        F.avg(label).alias("_mean"),
        *[F.array_distinct(F.percentile_approx(F.col(f).cast("double"), probs, F.lit(10_000))).alias(f"_e{i}") for i, f in enumerate(features)],
    )
    edges = staged(edges, "boosting_edges")

    def bin_of(i: int, feature: str) -> Column:
        x = F.col(feature).cast("double")
        return F.size(F.filter(f"_e{i}", lambda edge: edge < x)).cast("int")

    binned = attach(rows, edges, keys).withColumn("_b", F.array(*[bin_of(i, f) for i, f in enumerate(features)]))
    binned = binned.drop(*[f"_e{i}" for i in range(len(features))])
    names = rows.columns
    untrained = rows.join(edges.select(*keys), keys, "left_anti").withColumn("forecast", F.lit(None).cast("double"))
    large = edges.where(F.col("_n") > large_rows).count()
    small = binned.where(F.col("_n") <= large_rows) if large else binned
    out = _by_series(small, keys, names, label, train, rounds, depth, rate, bins, leaf_rows).unionByName(untrained)
    if large:
        spread = _by_level(binned.where(F.col("_n") > large_rows), keys, label, train, rounds, depth, rate, leaf_rows, large * 2**depth <= BROADCAST_SPLITS)
        out = out.unionByName(spread.select(*names, "forecast"))
    return out


def _by_series(rows: DataFrame, keys: list[str], names: list[str], label: str, train: str, rounds: int, depth: int, rate: float, bins: int, leaf_rows: int) -> DataFrame:
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in names) + ", forecast double"

    def fit(p: pd.DataFrame) -> pd.DataFrame:
        learned = p[train].fillna(False).to_numpy(bool)
        p["forecast"] = boost(np.stack(p["_b"].to_numpy()), p[label].to_numpy(float), learned, rounds, depth, rate, bins, leaf_rows)
        return p[[*names, "forecast"]]

    return rows.select(*names, "_b").groupBy(*keys).applyInPandas(fit, schema)


def boost(b: np.ndarray, y: np.ndarray, train: np.ndarray, rounds: int, depth: int, rate: float, bins: int, leaf_rows: int) -> np.ndarray:
    """Forecasts of all rows; ``b`` holds the bin of every feature."""
    n, m = b.shape
    cells = np.arange(m) * bins + b  # the place of each feature's bin in a node's histogram
    forecast = np.full(n, y[train].mean())
    for _ in range(rounds):
        residual = y - forecast
        node = np.zeros(n, np.int64)
        for level in range(depth):
            at = (node[train, None] * (m * bins) + cells[train]).ravel()
            shape = (1 << level, m, bins)
            count = np.bincount(at, minlength=np.prod(shape)).reshape(shape).cumsum(axis=2)
            total = np.bincount(at, np.repeat(residual[train], m), np.prod(shape)).reshape(shape).cumsum(axis=2)
            rows, sums = count[:, :, -1:], total[:, :, -1:]
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = total**2 / count + (sums - total) ** 2 / (rows - count) - sums**2 / rows
            gain[(count < leaf_rows) | (rows - count < leaf_rows)] = -1
            best = gain.reshape(shape[0], -1).argmax(axis=1)
            feature, cut = best // bins, best % bins
            split = gain.reshape(shape[0], -1).max(axis=1) > _LEAST_GAIN
            right = split[node] & (b[np.arange(n), feature[node]] > cut[node])
            node = 2 * node + right
        size = np.bincount(node[train], minlength=1 << depth)
        value = np.bincount(node[train], residual[train], 1 << depth) / np.maximum(size, 1)
        forecast = forecast + rate * value[node]
    return forecast


def _by_level(rows: DataFrame, keys: list[str], label: str, train: str, rounds: int, depth: int, rate: float, leaf_rows: int, broadcast: bool) -> DataFrame:
    small = F.broadcast if broadcast else (lambda df: df)
    base = staged(rows.withColumn("forecast", F.col("_mean")), "boosting_rows")
    names = base.columns
    for _ in range(rounds):
        now = base.withColumns({"_node": F.lit(0), "_r": F.col(label) - F.col("forecast")})
        for _ in range(depth):
            cells = now.where(train).select(*keys, "_node", "_r", F.posexplode("_b").alias("_f", "_bin"))
            cells = cells.groupBy(*keys, "_node", "_f", "_bin").agg(F.sum("_r").alias("_s"), F.count("*").alias("_c"))
            # At most one row per bin: small windows.
            whole = Window.partitionBy(*keys, "_node", "_f")
            so_far = whole.orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0)
            s, c, s_all, c_all = F.sum("_s").over(so_far), F.sum("_c").over(so_far), F.sum("_s").over(whole), F.sum("_c").over(whole)
            sides = cells.select(*keys, "_node", "_f", "_bin", s.alias("s"), c.alias("c"), (s_all - s).alias("t"), (c_all - c).alias("d"))
            gain = F.col("s") ** 2 / F.col("c") + F.col("t") ** 2 / F.col("d") - (F.col("s") + F.col("t")) ** 2 / (F.col("c") + F.col("d"))
            sides = sides.where((F.col("c") >= leaf_rows) & (F.col("d") >= leaf_rows)).withColumn("gain", gain).where(F.col("gain") > _LEAST_GAIN)
            best = F.max_by(F.struct("_f", "_bin"), F.struct("gain", -F.col("_f"), -F.col("_bin")))
            splits = staged(sides.groupBy(*keys, "_node").agg(best.alias("_split")), "boosting_splits")
            right = F.coalesce(F.get("_b", F.col("_split._f")) > F.col("_split._bin"), F.lit(False))
            now = now.join(small(splits), [*keys, "_node"], "left").withColumn("_node", 2 * F.col("_node") + right.cast("int")).drop("_split")
        leaves = now.where(train).groupBy(*keys, "_node").agg(F.avg("_r").alias("_value"))
        moved = now.join(small(leaves), [*keys, "_node"], "left")
        moved = moved.withColumn("forecast", F.col("forecast") + rate * F.coalesce("_value", F.lit(0.0)))
        base = staged(moved.select(*names), "boosting_rows")
    return base
