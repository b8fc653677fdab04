"""Quality operators on small hand-made series."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from conftest import START, values_of

from gridspark.operators import quality as q
from gridspark.operators import series as s

HALF = timedelta(minutes=30)


def test_step_found_once(make):
    rows = q.detect_step_changes(make([100.0] * 50 + [200.0] * 50), window_size=10).collect()
    assert len(rows) == 1
    step = rows[0]
    # The window before is flat, so every candidate is fully confident and the first one stands for the group.
    assert step["ts"] == START + 41 * HALF
    assert (step["value_before"], step["value_after"], step["magnitude"]) == (100.0, 110.0, 10.0)
    assert (step["relative_change"], step["direction"], step["confidence"]) == (0.1, "increase", 1.0)


def test_no_step_in_flat_or_short_series(make):
    assert q.detect_step_changes(make([100.0] * 100)).count() == 0
    assert q.detect_step_changes(make([100.0] * 10 + [200.0] * 10)).count() == 0
    assert q.detect_step_changes(make([0.0] * 50 + [5.0] * 50), window_size=10).where("value_before = 0").count() == 0


def test_group_starts_at_its_first_member(make, spark):
    from gridspark.operators.quality import _anchors
    import numpy as np

    t = np.array([0, 5, 9, 10, 14, 21, 22])
    assert _anchors(t, None, 10).tolist() == [0, 0, 0, 10, 10, 21, 21]
    assert _anchors(t, -4, 10).tolist() == [-4, -4, 9, 9, 9, 21, 21]


def test_gap_between_blocks(make):
    times = [START + i * HALF for i in range(20)] + [START + timedelta(hours=15) + i * HALF for i in range(20)]
    gap = q.identify_gaps(make([1.0] * 40, times=times)).collect()
    assert len(gap) == 1
    assert gap[0]["start"] == START + 19 * HALF and gap[0]["end"] == START + timedelta(hours=15)
    assert gap[0]["duration_hours"] == 5.5 and gap[0]["missing_points"] == 10


def test_gap_limit_is_strict_and_nulls_open_gaps(make):
    assert q.identify_gaps(make([1.0, None, 1.0])).count() == 0
    assert q.identify_gaps(make([1.0, None, None, 1.0])).collect()[0]["missing_points"] == 2
    assert q.identify_gaps(make([1.0])).count() == 0
    assert q.identify_gaps(make([None, None])).count() == 0


@pytest.mark.parametrize(
    ("method", "want"),
    [
        ("linear", [None, 10.0, 20.0, 30.0, 40.0, 40.0]),
        ("forward", [None, 10.0, 10.0, 10.0, 40.0, 40.0]),
        ("backward", [10.0, 10.0, 40.0, 40.0, 40.0, None]),
        ("mean", [25.0, 10.0, 25.0, 25.0, 40.0, 25.0]),
        ("median", [25.0, 10.0, 25.0, 25.0, 40.0, 25.0]),
    ],
)
def test_fill_methods(make, method, want):
    assert values_of(q.fill_gaps(make([None, 10, None, None, 40, None]), method)) == want


def test_linear_fill_weights_by_time(make):
    times = [START, START + timedelta(hours=1), START + timedelta(hours=4)]
    assert values_of(q.fill_gaps(make([0.0, None, 8.0], times=times))) == [0.0, 2.0, 8.0]


def test_bounded_fill_leaves_long_gaps(make):
    df = make([None, 1.0, None, 3.0, None, None, None, None, 8.0, None])
    assert values_of(q.fill_gaps(df, "linear", max_gap_hours=1.0)) == [None, 1.0, 2.0, 3.0, None, None, None, None, 8.0, 8.0]
    assert values_of(q.fill_gaps(df, "mean", max_gap_hours=1.0))[4] is None


def test_all_null_series_stays_null(make):
    for method in ("linear", "forward", "mean", "median"):
        assert values_of(q.fill_gaps(make([None] * 10), method)) == [None] * 10


def test_unknown_methods_raise(make):
    with pytest.raises(ValueError, match="is none of"):
        q.fill_gaps(make([1.0]), "spline")
    with pytest.raises(ValueError, match="is none of"):
        q.flag_outliers(make([1.0]), method="other")
    with pytest.raises(ValueError):
        q.detect_rolling_anomalies(make([1.0]), window_size=2)
    with pytest.raises(ValueError):
        q.summarize_flow_balance(make([1.0]), make([1.0]), tolerance=-1)


def test_outliers(make):
    values = [100.0 + i % 3 for i in range(100)]
    values[25], values[75] = 500.0, -200.0
    for method, limit in (("iqr", 3.0), ("zscore", 3.0), ("mad", 3.5)):
        rows = q.flag_outliers(make(values), method=method, threshold=limit).where("is_outlier").orderBy("ts").collect()
        assert [r["value"] for r in rows] == [500.0, -200.0]


def test_flat_series_has_no_zscore_or_mad_outliers(make):
    flat = make([100.0] * 30 + [None])
    for method in ("zscore", "mad", "iqr"):
        rows = q.flag_outliers(flat, method=method)
        assert rows.count() == 30 and rows.where("is_outlier").count() == 0


def test_spike_is_a_rolling_anomaly(make):
    values = [100.0] * 100
    values[40] = 500.0
    rows = q.detect_rolling_anomalies(make(values), window_size=12, threshold=4.0)
    assert rows.count() == 100
    assert [r["ts"] for r in rows.where("is_anomaly").collect()] == [START + 40 * HALF]


def test_redaction(spark):
    rows = [
        (datetime(2024, 1, 1), "10.0", 50.0),
        (datetime(2024, 1, 2), " REDACTED", 55.0),
        (datetime(2024, 2, 1), "12.0", None),
        (datetime(2024, 2, 2), "14.0", 53.0),
        (None, "REDACTED", 1.0),
    ]
    df = spark.createDataFrame(rows, "timestamp timestamp_ntz, active_power_mw string, loading_percent double")
    out = q.summarize_redaction_by_period(df, period="M").collect()
    assert [(r["period"], r["total_points"], r["redacted_points"], r["redaction_rate"]) for r in out] == [
        (datetime(2024, 1, 1), 2, 1, 0.5),
        (datetime(2024, 2, 1), 2, 1, 0.5),
    ]
    flags = q.detect_redaction(df, "active_power_mw", markers=["x"], include_missing=False)
    assert flags.where("is_redacted").count() == 0
    with pytest.raises(ValueError, match="no columns"):
        q.summarize_redaction_by_period(df, value_fields=["nope"])
    kept = q.within_period(df, q.least_redacted_period([q.summarize_redaction_by_period(df)]))
    assert kept.count() == 2


def test_month_end_bound_is_midnight(spark):
    rows = [(datetime(2024, 1, 31), 1.0), (datetime(2024, 1, 31, 12), 2.0)]
    df = spark.createDataFrame(rows, "timestamp timestamp_ntz, value double")
    month = spark.createDataFrame([(datetime(2024, 1, 1),)], "period timestamp_ntz")
    assert q.within_period(df, month).count() == 1
    assert q.within_period(df, month, end_inclusive_day=True).count() == 2


def test_flow_balance(make):
    hour = timedelta(hours=1)
    a, b = make([100, 110, 95, 105], hour), make([98, 108, 100, 103], hour)
    r = q.summarize_flow_balance(a, b, 0.1).first()
    assert (r["points_compared"], r["line_total"], r["transformer_total"], r["mean_abs_difference"]) == (4, 410.0, 409.0, 2.75)
    assert r["within_tolerance_ratio"] == 1.0
    empty = q.summarize_flow_balance(a, make([None] * 4, hour)).first()
    assert (empty["points_compared"], empty["mean_relative_difference"], empty["tolerance"]) == (0, 0.0, 0.2)
    zeros = q.summarize_flow_balance(a, make([0, 0, 0, 0], hour)).first()
    assert zeros["mean_relative_difference"] is None and zeros["within_tolerance_ratio"] == 0.0


def test_quality_report(make):
    values = [100.0] * 100
    for i in [*range(20, 26), *range(60, 70)]:
        values[i] = None
    r = q.quality_control(make(values)).first()
    assert (r["total_points"], r["valid_points"], r["missing_points"], r["outlier_points"], r["gap_count"]) == (100, 84, 16, 0, 2)
    assert r["quality_score"] == pytest.approx(84 - 10)
    assert r["issues"] == ["Missing data: 16 points (16.0%)", "Data gaps: 2 gaps totaling 9.0 hours"]
    nothing = q.quality_control(make([None] * 10)).first()
    assert (nothing["valid_points"], nothing["quality_score"]) == (0, 0.0)


def test_low_screen(make):
    rows = q.screen_low(make([0.0, 0.2, 50.0, 60.0, 2.0, None])).orderBy("ts").collect()
    assert [r["screened"] for r in rows] == [True, True, False, False, True, False] or [r["value"] for r in rows] == [None, None, 50.0, 60.0, 2.0, None]


def test_grid_and_upsample(make):
    times = [START, START, START + timedelta(hours=2)]
    assert values_of(s.regular_grid(make([1.0, 2.0, 5.0], times=times))) == [3.0, None, None, None, 5.0]
    hourly = make([10.0, 20.0, None], timedelta(hours=1))
    assert values_of(q.upsample(hourly)) == [10.0, 15.0, 20.0, 20.0, 20.0]


def test_feature_join_carries_forward(make, spark):
    weather = make([5.0], times=[START + HALF]).withColumnRenamed("value", "temperature")
    out = s.join_features(make([1.0, 2.0, 3.0]), weather)
    assert values_of(out, "temperature") == [None, 5.0, 5.0]


def test_to_series(spark):
    rows = [("2024-01-01T00:00:00Z", "1.5"), ("never", "x"), ("2024-01-01T01:00:00Z", "NaN")]
    df = spark.createDataFrame(rows, "timestamp string, active_power_mw string")
    out = s.to_series(df, value_field="active_power_mw").collect()
    assert [(r["ts"] and r["ts"].hour, r["value"]) for r in out] == [(0, 1.5), (None, None), (1, None)]
    with pytest.raises(ValueError, match="no column 'nope'"):
        s.to_series(df, value_field="nope")


def test_resample_keeps_empty_buckets(make):
    times = [datetime(2024, 1, 1, 3), datetime(2024, 1, 3, 4)]
    rows = s.resample(make([2.0, 4.0], times=times), "day").orderBy("ts").collect()
    assert [(r["count"], r["sum"], r["mean"]) for r in rows] == [(1, 2.0, 2.0), (0, 0.0, None), (1, 4.0, 4.0)]
