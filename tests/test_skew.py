"""Results must not depend on how large series are cut up."""

from __future__ import annotations

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridspark.operators import features as ft
from gridspark.operators import quality as q
from gridspark.operators import series as se
from gridspark.operators import stats as st
from gridspark.plans import CHUNK, attach, exact_quantiles, hot_groups, positions, split_hot
from gridspark.plans import skew

K = ["key"]


@pytest.fixture(scope="module")
def rows(spark):
    """One key with most rows, a burst, and a third of its rows at one instant."""
    n = 6000
    us = (
        F.when(F.col("id") % 3 == 0, F.lit(1_700_000_000_000_000))
        .when(F.col("id") % 3 == 1, 1_700_003_600_000_000 + F.col("id") * 1000)
        .otherwise(1_699_000_000_000_000 + F.col("id") * 997_000_000)
    )
    value = F.when(F.col("id") % 13 == 0, None).otherwise(F.round(50 + 40 * F.sin(F.col("id") / 7.0) + F.pmod(F.hash("id"), F.lit(100)) / 10, 2))
    df = spark.range(n).select(
        F.when(F.col("id") % 10 < 8, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 4)).alias("key"),
        "id",
        F.timestamp_micros(us).cast("timestamp_ntz").alias("ts"),
        value.alias("value"),
    )
    return df.persist()


def content(df):
    cols = [F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_chunks_are_bounded_and_ordered(rows):
    cut = split_hot(rows, K, "ts", "id", target_rows=100)
    sizes = [r["count"] for r in cut.groupBy("key", CHUNK).count().collect()]
    assert sum(sizes) == 6000 and max(sizes) <= 400 and len(sizes) > 20
    spans = cut.groupBy("key", CHUNK).agg(F.min(F.struct("ts", "id")).alias("a"), F.max(F.struct("ts", "id")).alias("b"))
    for key in ("hot", "k0"):
        ordered = [(tuple(r["a"]), tuple(r["b"])) for r in spans.where(F.col("key") == key).orderBy(CHUNK).collect()]
        assert all(prev[1] < nxt[0] for prev, nxt in zip(ordered, ordered[1:]))


def test_positions(rows):
    whole, cut = (positions(rows, K, "ts", "id", target_rows=t).select("key", "id", "_pos", "_n") for t in (None, 100))
    assert content(whole) == content(cut)


OPERATORS = {
    "step_changes": lambda d, t: q.detect_step_changes(d, K, window_size=6, threshold=0.05, min_confidence=0.01, tiebreak="id", target_rows=t),
    "gaps": lambda d, t: q.identify_gaps(d, K, min_gap_hours=0.2, target_rows=t),
    "fill_linear": lambda d, t: q.fill_gaps(d, "linear", K, tiebreak="id", target_rows=t),
    "fill_bounded": lambda d, t: q.fill_gaps(d, "backward", K, max_gap_hours=0.5, tiebreak="id", target_rows=t),
    "fill_median": lambda d, t: q.fill_gaps(d, "median", K, target_rows=t),
    "outliers": lambda d, t: q.flag_outliers(d, K, method="mad", threshold=1.0, target_rows=t),
    "rolling": lambda d, t: q.detect_rolling_anomalies(d, K, window_size=12, threshold=3.0, tiebreak="id", target_rows=t),
    "report": lambda d, t: q.quality_control(d, K, target_rows=t),
    "acf": lambda d, t: st.autocorrelation(d, K, lags=12, tiebreak="id", target_rows=t),
    "peaks": lambda d, t: st.peak_analysis(d, 40.0, K, tiebreak="id", target_rows=t).drop("peak_timestamp", "trough_timestamp"),
    "features": lambda d, t: ft.load_features(d, K, lags=(1, 30), windows=(("m", "mean", 8), ("s", "std", 5)), tiebreak="id", target_rows=t),
    "carry": lambda d, t: se.carry_forward(d, ["value"], K, tiebreak="id", target_rows=t),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_cut_series_give_the_same(rows, name):
    assert content(OPERATORS[name](rows, None)) == content(OPERATORS[name](rows, 100))


def test_step_groups_against_a_plain_loop(rows):
    """Dense candidates: groups must chain across chunk borders."""
    found = q.step_candidates(rows, K, window_size=6, threshold=0.05, min_confidence=0.01, tiebreak="id")
    want = []
    for key in ("hot", "k0", "k1", "k2", "k3"):
        group, out = [], []
        for r in found.where(F.col("key") == key).orderBy("_pos").collect():
            if group and (r["ts"] - group[0]["ts"]).total_seconds() >= 6 * 3600:
                out.append(max(group, key=lambda g: g["confidence"]))
                group = []
            group.append(r)
        out += [max(group, key=lambda g: g["confidence"])] if group else []
        want += [(key, r["ts"], round(r["confidence"], 6)) for r in out]
    got = q.detect_step_changes(rows, K, window_size=6, threshold=0.05, min_confidence=0.01, tiebreak="id", target_rows=40)
    assert sorted(want) == sorted((r["key"], r["ts"], round(r["confidence"], 6)) for r in got.collect())


def test_bracketed_quantiles_are_exact(spark):
    df = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "small").otherwise("big").alias("key"),
        F.when(F.col("id") % 5 == 0, 7.0).otherwise(F.exp(F.pmod(F.xxhash64("id"), F.lit(100_000)) / 9000.0)).alias("v"),
    )
    probs = {"p0": 0.0, "p10": 0.1, "p33": 0.333, "p50": 0.5, "p99": 0.99, "p100": 1.0}
    got = {r["key"]: r for r in exact_quantiles(df, K, "v", probs, [F.count("*").alias("n")], builtin_rows=1, accuracy=1000).collect()}
    for key in ("small", "big"):
        x = np.array([r["v"] for r in df.where(F.col("key") == key).collect()])
        assert got[key]["n"] == len(x)
        for name, p in probs.items():
            assert got[key][name] == pytest.approx(np.quantile(x, p), rel=1e-12)


def test_attach_salts_only_large_groups(rows):
    stats = rows.groupBy("key").agg(F.max("id").alias("m"))
    whole, cut = attach(rows, stats, K), attach(rows, stats, K, target_rows=100)
    assert content(whole) == content(cut)


def test_hot_list_is_bounded(rows, monkeypatch):
    assert hot_groups(rows, K, target_rows=100, limit=2).count() == 2
    assert hot_groups(rows, K) is None
    assert hot_groups(rows, K, target_rows=10**9, at_most=5) is None
    assert skew.MAX_HOT_GROUPS <= 100_000


def test_growing_a_series_adds_rows_not_tasks_worth_of_state(rows):
    """The plan of a cut series never windows by the series key alone over the rows themselves."""
    plan = positions(rows, K, "ts", "id", target_rows=100)._jdf.queryExecution().optimizedPlan().toString()
    numbered = [line for line in plan.splitlines() if "row_number()" in line]
    assert numbered and all(CHUNK in line for line in numbered)


def test_text_ties_with_a_common_beginning_are_cut(spark):
    rows = spark.range(5000).select(F.lit("k").alias("key"), F.lit("2024-01-01").cast("timestamp_ntz").alias("ts"), F.format_string("event-%06d", "id").alias("name"))
    sizes = [r["count"] for r in split_hot(rows, ["key"], "ts", "name", target_rows=100).groupBy("_chunk").count().collect()]
    assert sum(sizes) == 5000 and max(sizes) <= 400


def test_chained_operators_measure_once(spark, make, monkeypatch):
    from gridspark.operators import quality, series

    jobs = []
    measured = type(spark.range(1))
    for name in ("first", "collect"):
        def counted(self, *args, f=getattr(measured, name), **more):
            jobs.append(name)
            return f(self, *args, **more)

        monkeypatch.setattr(measured, name, counted)
    df = make([float(i % 50) for i in range(200)]).withColumn("k", F.lit("a"))
    screened = quality.screen_low(df, ["k"]).drop("screened")
    after_one = len(jobs)
    filled = quality.fill_gaps(screened.where("value is null or value < 100"), "linear", ["k"], max_gap_hours=6.0)
    flagged = quality.flag_outliers(filled, ["k"])
    quality.quality_control(flagged, ["k"])
    assert 0 < after_one == len(jobs)
    assert skew.known_size(flagged, ["k"]) == 200 == skew.known_size(flagged, ["k", "value"])
    assert skew.known_size(flagged, ["value"]) is None and skew.known_size(series.regular_grid(flagged, ["k"]), ["k"]) is None


def test_peak_analysis_reads_its_rows_three_times(spark, make, tmp_path):
    from gridspark.operators import stats

    make([float(i % 50) for i in range(400)]).withColumn("k", F.lit("a")).write.parquet(f"{tmp_path}/t")
    out = stats.peak_analysis(spark.read.parquet(f"{tmp_path}/t"), keys=["k"])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"Relation \[[^\]]*\bts#", plan)) == 2  # the first read is over by now
    row = out.first()
    assert row["peak_value"] == 49.0 and len(row["peak_hours"]) <= 3 and row["max_consecutive_above_threshold"] == 5
