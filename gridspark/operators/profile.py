"""Table profiling: grouped statistics, pivots, value counts, missing values, summaries, correlation."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridspark.plans import wide_quantiles


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


# Statistics a grouped report may ask for.
_STATS = {"count": F.count, "mean": F.avg, "sum": F.sum, "min": F.min, "max": F.max}


def group_statistics(df: DataFrame, by: str | Sequence[str], value: str, stats: Sequence[str] = ("count", "mean", "sum", "min", "max"), digits: int | None = 2) -> DataFrame:
    """Statistics of ``value`` for each combination of the ``by`` columns; null groups are left out."""
    by = [by] if isinstance(by, str) else list(by)
    aggs = []
    for s in stats:
        col = _STATS[s](value)
        aggs.append((F.round(col, digits) if digits is not None and s != "count" else col).alias(s))
    return df.dropna(subset=by).groupBy(*by).agg(*aggs)


def pivot(df: DataFrame, row: str, column: str, value: str, columns: Sequence, how: str = "mean", fill: float | None = 0, digits: int | None = None) -> DataFrame:
    """Row key by column key table. The column values are given, so no extra pass looks for them."""
    agg = _STATS[how](value)
    out = df.groupBy(row).pivot(column, list(columns)).agg(F.round(agg, digits) if digits is not None else agg)
    return out if fill is None else out.fillna(fill, subset=[str(c) for c in columns])


def value_counts(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """Rows per value, most frequent first (ties by value); nulls are not counted."""
    out = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("count"))
    out = out.orderBy(F.desc("count"), column)
    return out if top is None else out.limit(top)


def missing_profile(df: DataFrame) -> DataFrame:
    """Null count and percentage per column, in one pass."""
    total = F.count("*")
    cells = []
    for c in df.columns:
        missing = F.count("*") - F.count(F.col(f"`{c}`"))
        share = F.round(100.0 * missing / F.nullif(total, F.lit(0)), 2)
        cells.append(F.struct(F.lit(c).alias("column"), missing.alias("missing"), share.alias("percent")))
    return df.agg(F.array(*cells).alias("_c")).select(F.explode("_c").alias("_c")).select("_c.*")


def numeric_summary(df: DataFrame, columns: Sequence[str] | None = None, builtin_rows: int | None = None) -> DataFrame:
    """Count, mean, std, min, quartiles and max per numeric column, long form."""
    columns = list(columns or numeric_columns(df))
    if not columns:
        raise ValueError("no numeric columns")

    def stats(v):
        return {"count": F.count(v), "mean": F.avg(v), "std": F.stddev_samp(v), "min": F.min(v), "max": F.max(v)}

    values = {c: F.col(f"`{c}`").cast("double") for c in columns}
    rows = wide_quantiles(df, values, {"q25": 0.25, "q50": 0.5, "q75": 0.75}, stats, builtin_rows)
    return rows.where(F.col("count") > 0)


def categorical_profile(df: DataFrame, columns: Sequence[str] | None = None, max_values: int = 10) -> DataFrame:
    """Distinct count per text column, with value counts for columns that have few values.

    Distinct values are counted by a 128-bit hash, so that no text of a column with many values is ever moved. That job runs when the plan
    is built (one row per column comes back); the few values of the other columns are then read by themselves.
    """
    columns = list(columns or text_columns(df))
    value = {c: F.col(f"`{c}`") for c in columns}
    cells = [F.when(v.isNotNull(), F.struct(F.lit(i).alias("i"), F.xxhash64(v).alias("a"), F.xxhash64(v, F.lit(1)).alias("b"))) for i, v in enumerate(value.values())]
    hashes = df.select(F.explode(F.array_compact(F.array(*cells))).alias("_c")).select("_c.*").distinct()
    distinct = dict(hashes.groupBy("i").agg(F.count("*").alias("n")).collect())
    spark = df.sparkSession
    totals = spark.createDataFrame([(columns[i], n) for i, n in sorted(distinct.items())], "column string, distinct_values long")
    few = [columns[i] for i, n in sorted(distinct.items()) if n <= max_values]
    if not few:
        return totals.withColumns({"value": F.lit(None).cast("string"), "count": F.lit(None).cast("long")})
    listed = F.array(*[F.struct(F.lit(c).alias("column"), value[c].alias("value")) for c in few])
    counts = df.select(F.explode(listed).alias("_c")).select("_c.*").where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count("*").alias("count"))
    # At most max_values rows per column on the other side.
    return totals.join(F.broadcast(counts), "column", "left")


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct non-null values."""
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation for every pair of numeric columns over rows where both are filled.

    A first aggregate gives the means (one row). Around them, each task adds up the products of all columns with all
    others batch by batch, as matrices of values, squares and filled cells; what it sends is one row per pair.
    """
    columns = list(columns or numeric_columns(df))
    if not columns:
        raise ValueError("no numeric columns")
    x = {c: F.col(f"`{c}`").cast("double") for c in columns}
    # The mean of equal values may be a rounding away from them.
    mean = lambda v: F.when(F.min(v) == F.max(v), F.min(v)).otherwise(F.avg(F.when(~F.isnan(v), v)))
    row = df.agg(*[mean(v) for v in x.values()]).first()
    centre = np.array([v if v is not None and math.isfinite(v) else 0.0 for v in row])
    first, second = np.triu_indices(len(columns))

    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = None
        for b in batches:
            filled = np.column_stack([c.is_valid().to_numpy(zero_copy_only=False) for c in b.columns]).astype(float)
            # A null is nothing to add; NaN stays NaN and makes the correlations of its column undefined.
            v = np.column_stack([pc.fill_null(c, 0.0).to_numpy(zero_copy_only=False) for c in b.columns]) - centre
            v[filled == 0] = 0.0
            with np.errstate(invalid="ignore", over="ignore"):
                parts = [filled.T @ filled, v.T @ filled, filled.T @ v, (v * v).T @ filled, filled.T @ (v * v), v.T @ v]
            sums = parts if sums is None else [s + p for s, p in zip(sums, parts)]
        if sums is not None:
            yield pa.RecordBatch.from_arrays([pa.array(first), pa.array(second), *[pa.array(s[first, second]) for s in sums]], names=["i", "j", "n", "x", "y", "xx", "yy", "xy"])

    rows = df.select(*[v.alias(f"c{k}") for k, v in enumerate(x.values())]).mapInArrow(gram, "i long, j long, " + ", ".join(f"{n} double" for n in ("n", "x", "y", "xx", "yy", "xy")))
    total = rows.groupBy("i", "j").agg(*[F.sum(n).alias(n) for n in ("n", "x", "y", "xx", "yy", "xy")])
    # What is left of a constant column is rounding.
    n = F.nullif(F.col("n"), F.lit(0.0))
    spread = lambda s, ss: F.when(F.col(ss) - F.col(s) ** 2 / n > 1e-12 * F.col(ss), F.col(ss) - F.col(s) ** 2 / n)
    r = (F.col("xy") - F.col("x") * F.col("y") / n) / F.sqrt(spread("x", "xx") * spread("y", "yy"))
    r = F.when(F.col("i") == F.col("j"), F.when(r.isNotNull() & ~F.isnan(r), 1.0)).otherwise(r)
    total = total.select("i", "j", F.when(r.isNotNull() & (F.col("n") > 1) & ~F.isnan(r), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r))).alias("correlation"))
    name = F.array(*[F.lit(c) for c in columns])
    both = F.when(F.col("i") == F.col("j"), F.array(F.struct("i", "j"))).otherwise(F.array(F.struct("i", "j"), F.struct(F.col("j").alias("i"), F.col("i").alias("j"))))
    pairs = total.select(F.explode(both).alias("_p"), "correlation")
    return pairs.select(F.get(name, F.col("_p.i").cast("int")).alias("column_a"), F.get(name, F.col("_p.j").cast("int")).alias("column_b"), "correlation")
