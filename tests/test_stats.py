"""Statistics on small hand-made series, checked against numpy and pandas."""

from __future__ import annotations

import math
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from conftest import START

from gridspark.operators import profile as pr
from gridspark.operators import stats as st

HALF = timedelta(minutes=30)


def test_describe_varying(make):
    r = st.describe_timeseries(make(range(1, 101))).first()
    x = np.arange(1, 101, dtype=float)
    s = x.std(ddof=1)
    assert (r["count"], r["mean"], r["median"], r["min"], r["max"]) == (100, 50.5, 50.5, 1.0, 100.0)
    assert r["std"] == pytest.approx(s)
    assert r["p10"] == pytest.approx(np.quantile(x, 0.1)) and r["p99"] == pytest.approx(np.quantile(x, 0.99))
    assert r["skewness"] == pytest.approx(((x - 50.5) ** 3).mean() / s**3, abs=1e-9)
    assert r["kurtosis"] == pytest.approx(((x - 50.5) ** 4).mean() / s**4 - 3)


def test_describe_edges(make):
    flat = st.describe_timeseries(make([100.0] * 100)).first()
    assert (flat["std"], flat["skewness"], flat["kurtosis"]) == (0.0, 0.0, 0.0)
    two = st.describe_timeseries(make([100, 200])).first()
    assert two["skewness"] is None and two["kurtosis"] is None and two["std"] == pytest.approx(70.7106781)
    three = st.describe_timeseries(make([100, 200, 150])).first()
    assert three["skewness"] is not None and three["kurtosis"] is None
    none = st.describe_timeseries(make([None] * 10)).first()
    assert (none["count"], none["mean"], none["p50"]) == (0, None, None)
    odd = st.describe_timeseries(make([1.0, 2.0, float("inf"), float("-inf"), 3.0])).first()
    assert (odd["count"], odd["max"], odd["excluded_non_finite_count"], odd["has_non_finite_values"]) == (3, 3.0, 2, True)


def daily_values():
    return [100 + 5 * (h - 6) if 6 <= (h := (START + i * HALF).hour) <= 22 else 50 for i in range(336)]


def test_seasonal(make):
    df = make(daily_values())
    hints = st.describe_timeseries(df).first()
    assert hints["has_daily_pattern"] is True and hints["daily_variation_cv"] > 0.05
    profile = {r["unit"]: r for r in st.seasonal_pattern(df, "daily").collect()}
    assert len(profile) == 24 and profile[22]["mean"] == 180.0 and profile[0]["mean"] == 50.0 and profile[22]["std"] == 0.0
    top = st.seasonal_summary(df, "daily").first()
    assert (top["dominant_unit"], top["range_ratio"]) == (22, 3.6)
    with pytest.raises(ValueError, match="is none of"):
        st.seasonal_pattern(df, "hourly")


def test_hints_need_enough_points(make):
    short = st.describe_timeseries(make([1.0, 2.0] * 20)).first()
    assert short["daily_variation_cv"] is None and short["weekly_variation_cv"] is None
    weekly = [150 if (START + i * HALF).weekday() < 5 else 80 for i in range(4 * 336)]
    row = st.describe_timeseries(make(weekly)).first()
    assert row["has_weekly_pattern"] is True


def test_range_ratio_of_zeros(make):
    assert st.seasonal_summary(make([0.0] * 50)).first()["range_ratio"] == 1.0
    mixed = st.seasonal_summary(make([0.0] * 2 + [4.0] * 2)).first()
    assert math.isinf(mixed["range_ratio"]) and mixed["dominant_unit"] == 1


def acf(values, lags):
    x = np.asarray(values, dtype=float)
    d, n, var = x - x.mean(), len(x), x.var(ddof=1)
    return [1.0] + [float((d[k:] * d[:-k]).sum() / n / var) for k in range(1, min(lags, n - 1) + 1)]


def test_autocorrelation(make):
    values = daily_values()
    got = [r["autocorrelation"] for r in st.autocorrelation(make([*values, None]), lags=48).orderBy("lag").collect()]
    assert got == pytest.approx(acf(values, 48))
    flat = [r["autocorrelation"] for r in st.autocorrelation(make([5.0] * 4), lags=10).collect()]
    assert flat == [1.0] * 4
    single = st.autocorrelation(make([5.0]), lags=10).collect()
    assert [(r["lag"], r["autocorrelation"]) for r in single] == [(0, 1.0)]
    assert st.autocorrelation(make([None]), lags=10).count() == 0


def test_peaks(make):
    values = [100.0] * 100
    for i in [10, 11, 12, 13, 50, 51, 75]:
        values[i] = 200.0
    values[75] = 300.0
    r = st.peak_analysis(make(values)).first()
    assert (r["peak_value"], r["peak_timestamp"], r["trough_value"], r["trough_timestamp"]) == (300.0, START + 75 * HALF, 100.0, START)
    assert r["max_consecutive_above_threshold"] == 4 and r["time_above_threshold_pct"] == 7.0
    above = pd.Series([(START + i * HALF).hour for i in [10, 11, 12, 13, 50, 51, 75]]).value_counts()
    best = sorted(above.items(), key=lambda kv: (-kv[1], kv[0]))[:3]
    assert r["peak_hours"] == [h for h, _ in best]
    assert r["peak_to_trough_ratio"] == 3.0


def test_peak_edges(make):
    flat = st.peak_analysis(make([0.0] * 5)).first()
    assert (flat["peak_to_trough_ratio"], flat["mean_to_peak_ratio"], flat["max_consecutive_above_threshold"], flat["peak_hours"]) == (1.0, 1.0, 0, [])
    zero_trough = st.peak_analysis(make([0.0, 5.0])).first()
    assert math.isinf(zero_trough["peak_to_trough_ratio"])
    none = st.peak_analysis(make([None] * 3)).first()
    assert none["peak_value"] is None and none["time_above_threshold_pct"] == 0.0


def test_correlation_is_pairwise_complete(spark):
    rows = [(1.0, 2.0, None), (2.0, 4.0, 5.0), (3.0, 7.0, 1.0), (4.0, None, 2.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    want = pd.DataFrame(rows, columns=["a", "b", "c"]).corr()
    for r in pr.correlation_matrix(df).collect():
        assert r["correlation"] == pytest.approx(want.loc[r["column_a"], r["column_b"]])


def test_months(make):
    values, t = [], datetime(2022, 1, 1)
    for i in range(730):
        m = (t + timedelta(days=i)).month
        values.append(200 if m in (12, 1, 2) else 100 if m in (6, 7, 8) else 150)
    top = st.seasonal_summary(make(values, timedelta(days=1), t), "annual").first()
    assert (top["dominant_unit"], top["range_ratio"]) == (1, 2.0)


def test_wide_summary_by_brackets(spark):
    from gridspark.operators import profile

    df = spark.range(300_000).selectExpr("id * 7919 % 300007 AS a", "CAST(id % 3 AS DOUBLE) AS b", "IF(id < 5, CAST(id AS DOUBLE), NULL) AS c", "CAST(NULL AS INT) AS d")
    cut = {r["column"]: r for r in profile.numeric_summary(df, builtin_rows=1).collect()}
    whole = {r["column"]: r for r in profile.numeric_summary(df, builtin_rows=10**9).collect()}
    assert cut == whole and set(cut) == {"a", "b", "c"}


def test_a_bracket_that_misses_its_rank_is_widened(spark, monkeypatch):
    from pyspark.sql import functions as F

    from gridspark.plans import quantiles

    df = spark.range(0, 200_000, 1, 3).selectExpr("CAST(id * 7919 % 200003 AS DOUBLE) AS a", "CAST(id % 2 AS DOUBLE) AS b")
    values, probs = {c: F.col(c) for c in "ab"}, {"lo": 0.0, "q": 0.37, "m": 0.5, "hi": 1.0}
    count = lambda v: {"n": F.count(v)}
    exact = {r["column"]: r for r in quantiles.wide_quantiles(df, values, probs, count, builtin_rows=10**9).collect()}
    tried, brackets = [], quantiles.F.count_if
    monkeypatch.setattr(quantiles, "WIDE_SKETCH", 8)  # ranks off by far more than the brackets allow for
    monkeypatch.setattr(quantiles.F, "count_if", lambda c: (tried.append(1), brackets(c))[1])
    assert {r["column"]: r for r in quantiles.wide_quantiles(df, values, probs, count, builtin_rows=1, error=1e-7).collect()} == exact
    assert len(tried) > 2 * len(values) * len(probs)


def test_correlations_of_many_columns(spark):
    import numpy as np
    import pandas as pd
    from pyspark.sql import functions as F

    from gridspark.operators import profile as pr

    rng = np.random.default_rng(4)
    base = rng.normal(size=(300, 5))
    values = base @ rng.normal(size=(5, 200)) + 0.1 * rng.normal(size=(300, 200))
    values[:, 3] += 1e9
    values[:, 4] = 0.1
    frame = pd.DataFrame(values, columns=[f"c{i}" for i in range(200)]).mask(rng.random((300, 200)) < 0.1)
    frame["none"] = np.nan
    df = spark.createDataFrame(frame.astype(object).where(frame.notna(), None).values.tolist(), ", ".join(f"{c} double" for c in frame.columns)).repartition(3)
    out = pr.correlation_matrix(df)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "corr(" not in plan and out.count() == 201 * 201
    want = frame.corr()
    for r in out.collect():
        w = want.loc[r["column_a"], r["column_b"]]
        if "c4" in (r["column_a"], r["column_b"]) or np.isnan(w):
            assert r["correlation"] is None
        else:
            assert r["correlation"] == pytest.approx(w, abs=1e-6 if "c3" in (r["column_a"], r["column_b"]) else 1e-9)
    odd = spark.createDataFrame([(1.0, 2.0), (float("nan"), 3.0), (2.0, 5.0)], "a double, b double")
    assert {(r["column_a"], r["column_b"]): r["correlation"] for r in pr.correlation_matrix(odd).collect()}["a", "b"] is None


def test_texts_of_columns_with_many_values_are_not_moved(spark):
    from gridspark.operators import profile as pr

    df = spark.range(500).selectExpr("CONCAT('x', id) AS many", "IF(id % 4 = 0, NULL, CONCAT('y', id % 3)) AS few", "CAST(NULL AS STRING) AS none")
    out = pr.categorical_profile(df, max_values=3)
    rows = {(r["column"], r["value"]): (r["distinct_values"], r["count"]) for r in out.collect()}
    assert rows == {("many", None): (500, None), ("few", "y0"): (3, 125), ("few", "y1"): (3, 125), ("few", "y2"): (3, 125)}
    assert "many" not in out._jdf.queryExecution().optimizedPlan().toString().split("Relation")[-1].split("Generate")[-1]
    assert {r["column"]: r["value"] for r in pr.categorical_profile(df, max_values=2).collect()} == {"many": None, "few": None}


def test_missed_bracket_is_an_error(spark):
    import pytest

    from gridspark.plans import quantiles

    rows = spark.range(1).selectExpr("1.0D AS _lo0", "CAST(NULL AS DOUBLE) AS _hi0", "10L AS _n")
    with pytest.raises(Exception, match="raise accuracy"):
        rows.select(*quantiles._interpolated({"q": 0.3}, "x")).collect()
