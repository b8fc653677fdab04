"""Mixing sources to target weights by entropy balancing.

Every document starts with rate 1. Per source, the rates r are sought that take its target of words, sum(r * size) =
target, with 0 <= r <= cap, at the least relative entropy sum(v * (r * log(r) - r + 1)); the price v of a document's
departure is size / u, with the exposure u = 1 + log(1 + size / mean size of the source). The solution is an exponential
tilt, r = min(cap, exp(t * u)), one multiplier t a source: a source that is thinned keeps more of its short documents
(more different ones for the same words), one that is repeated repeats its long ones. With v = size every document
would get the same rate; with v = 1, so u = size, a few very long texts would take the whole tilt.

Newton's method solves the convex dual for all sources at once, each step one grouped sum over the distinct sizes of each
source; a step that leaves the bracket of its root is replaced by a bisection. Rates become copies by error diffusion
over units of documents of about the same size, large ones first.

Rows: a null text has size 0, a null source is a source of its own (last), repeated ids count as rows. A source
without words has target 0 and takes 0 copies. An empty table gives no rows. Very long texts are one document each. Columns other
than id, text and source are not read, and :func:`take` gives them back whatever they are called. Reruns agree: only ids decide on rounding.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, WORD, attach, fresh, keep, read

CAP = 3
WEIGHTS = (5, 2, 1)
STEPS = 40
TOLERANCE = 1e-9
#: Documents of a source and size class are dealt into so many units by a hash of their id.
UNITS = 64


def words(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, cap: int = CAP) -> DataFrame:
    """One row per source (_key, source, n, source_size, target): weights repeat along the sources by code
    point, null last; no target exceeds ``cap`` times its source, what exceeds it is shared among the others."""
    s = sizes.groupBy("_key").agg(F.first("source").alias("source"), F.count(F.lit(1)).alias("n"), F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), "source")
    s = s.withColumn("w", F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int")))
    s = s.withColumn("limit", F.col("source_size") * float(cap)).withColumn("ratio", F.col("limit") / F.col("w"))
    before = Window.orderBy("ratio", "_key").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(1))
    level = (F.sum("source_size").over(whole) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / (F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
    s = s.withColumn("level", level).withColumn("full", F.col("level") >= F.col("ratio"))
    s = s.withColumn("level", F.min(F.when(~F.col("full"), F.struct("ratio", "_key", "level"))).over(whole)["level"])
    return s.withColumn("target", F.when(F.col("full"), F.col("limit")).otherwise(F.col("w") * F.col("level"))).drop("w", "limit", "ratio", "level", "full")


def exposure(size: Column, n: Column, source_size: Column) -> Column:
    """How strongly the tilt of its source acts on a document: at least 1, growing with the logarithm of its size."""
    return 1.0 + F.log1p(size * n / source_size)


def balance(sizes: DataFrame, sources: DataFrame, cap: int = CAP, steps: int = STEPS, tolerance: float = TOLERANCE) -> DataFrame:
    """The dual's solution: (_key, tilt, error) of each source that has words; error is the dual's gradient by the target.

    As u >= 1, the root lies between log(share) and 0, share = target / source_size; the steps start at log(share) and
    work on the logarithm of the words taken, which is nearly a line in the tilt.
    """
    sources = sources.filter("source_size > 0")
    cells = sizes.filter("size > 0").groupBy("_key", "size").agg(F.count(F.lit(1)).alias("m"))
    per_source = sources.select("_key", "n", "source_size", F.col("n").alias("_n"))
    u = exposure(F.col("size"), F.col("n"), F.col("source_size"))
    cells = keep(attach(cells, per_source, ["_key"], "_n", ["size"]).select("_key", (F.col("m") * F.col("size")).alias("w"), u.alias("u")), "cells")
    log_share = F.log(F.col("target") / F.col("source_size"))
    edges = F.least(log_share, F.lit(0.0)).alias("low"), F.greatest(log_share, F.lit(0.0)).alias("high")
    now = keep(sources.select("_key", "n", "target", log_share.alias("tilt"), *edges, F.lit(None).cast("double").alias("error")), "dual")
    for _ in range(steps):
        rows = attach(cells, now.select("_key", "tilt", F.col("n").alias("_n")), ["_key"], "_n", ["u"])
        words_at = F.col("w") * F.least(F.exp(F.col("tilt") * F.col("u")), F.lit(float(cap)))
        free = F.col("tilt") * F.col("u") < math.log(cap)
        sums = rows.groupBy("_key").agg(F.sum(words_at).alias("f"), F.sum(F.when(free, words_at * F.col("u")).otherwise(0.0)).alias("df"))
        gap = F.col("f") - F.col("target")
        low, high = F.when(gap <= 0, F.col("tilt")).otherwise(F.col("low")), F.when(gap >= 0, F.col("tilt")).otherwise(F.col("high"))
        newton = F.col("tilt") - F.log(F.col("f") / F.col("target")) * F.col("f") / F.nullif(F.col("df"), F.lit(0.0))
        error = F.abs(gap) / F.col("target")
        stepped = now.drop("error").join(sums, "_key").withColumns({"low": low, "high": high, "newton": newton, "error": error})
        tilt = F.when(F.col("error") < tolerance, F.col("tilt")).when((F.col("newton") >= F.col("low")) & (F.col("newton") <= F.col("high")), F.col("newton")).otherwise((F.col("low") + F.col("high")) / 2)
        now = keep(stepped.select("_key", "n", "target", tilt.alias("tilt"), "low", "high", "error"), "dual")
        worst = now.agg(F.max("error")).first()[0]
        if worst is None or worst < tolerance:
            break
    return now.select("_key", F.round("tilt", 12).alias("tilt"), "error")


def _diffuse(units: DataFrame) -> DataFrame:
    """Units (_key, _class, _unit) that take one copy more, so that the words taken follow the words wanted within a source.

    A source has at most 64 size classes times UNITS units; its list is bounded.
    """
    lists = units.groupBy("_key").agg(F.array_sort(F.collect_list(F.struct((-F.col("_class")).alias("c"), F.col("_unit").alias("u"), F.col("tokens").cast("double").alias("t"), F.col("wanted").alias("w")))).alias("l"))
    start = F.struct(F.lit(0.0).alias("e"), F.array().cast("array<boolean>").alias("p"))

    def step(acc, x):
        e = acc["e"] + x["w"]
        take = (x["t"] > 0) & (e >= x["t"] / 2)
        return F.struct(F.when(take, e - x["t"]).otherwise(e).alias("e"), F.concat(acc["p"], F.array(take)).alias("p"))

    picked = lists.select("_key", F.explode(F.arrays_zip("l", F.aggregate("l", start, step)["p"].alias("p"))).alias("x"))
    return picked.select("_key", (-F.col("x.l.c")).alias("_class"), F.col("x.l.u").alias("_unit"), F.col("x.p").alias("_extra"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``id_col, source, size, source_size, target, rate, copies, taken``, one row per document."""
    source = F.col(source_col).cast("string")
    key = F.coalesce(F.concat(F.lit("s"), source), F.lit("n"))
    sizes = keep(docs.select(F.col(id_col).alias("_id"), source.alias("source"), key.alias("_key"), words(text_col).alias("size")), "sizes")
    sources = keep(targets(sizes, weights, cap), "sources")
    dual = balance(sizes, sources, cap).drop("error")
    table = keep(sources.join(dual, "_key", "left").withColumn("_n", F.col("n")), "rates")
    u = exposure(F.col("size"), F.col("n"), F.nullif(F.col("source_size"), F.lit(0)))
    rate = F.least(F.coalesce(F.exp(F.col("tilt") * u), F.lit(0.0)), F.lit(float(cap)))
    rows = attach(sizes, table.drop("source"), ["_key"], "_n", ["_id"]).withColumn("rate", F.round(rate, 9))
    rows = rows.withColumn("_class", F.floor(F.log2(F.col("size") + 1.0)).cast("int")).withColumn("_unit", F.pmod(F.xxhash64("_id"), F.lit(UNITS)).cast("int"))
    rows = keep(rows.select("_id", "source", "_key", "size", "source_size", "target", "rate", "_class", "_unit"), "rated")
    part = F.col("rate") - F.floor("rate")
    units = rows.groupBy("_key", "_class", "_unit").agg(F.sum(F.when(part > 0, F.col("size")).otherwise(0)).alias("tokens"), F.sum(F.col("size") * part).alias("wanted"), F.count(F.lit(1)).alias("_n"))
    extra = keep(_diffuse(units).join(units.select("_key", "_class", "_unit", "_n"), ["_key", "_class", "_unit"]), "extra")
    rows = attach(rows, extra, ["_key", "_class", "_unit"], "_n", ["_id"])
    copies = F.least(F.floor("rate") + F.when(F.col("_extra") & (part > 0), 1).otherwise(0), F.lit(cap)).cast("int")
    rows = rows.withColumn("copies", F.when(F.col("size") > 0, copies).otherwise(F.lit(0)))
    return rows.select(F.col("_id").alias(id_col), "source", "size", "source_size", "target", "rate", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def take(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``docs`` with every row as often as the mix takes it; rows of copied ids share their copies' number.

    Copies join on the id; rows that repeat an id take the smallest number that one of them got. A row with null id
    takes the number of the null ids.
    """
    taken, copies, copy = fresh(docs, "_taken_id", "_copies", "_copy")
    n = mix(docs, id_col, text_col, source_col, weights, cap).groupBy(F.col(id_col).alias(taken)).agg(F.min("copies").alias(copies)).filter(F.col(copies) > 0)
    n = keep(n, "copies")
    if n.count() <= 10 * BROADCAST_ROWS:
        n = F.broadcast(n)
    rows = docs.join(n, F.col(id_col).eqNullSafe(F.col(taken)))
    return rows.withColumn(copy, F.explode(F.sequence(F.lit(1), copies))).select(*docs.columns)


def op1_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mix(read(spark, sf, "documents")).select("doc_id", "size", "source_size", "target", "taken", "rate", "copies")
