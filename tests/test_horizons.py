"""Horizons of few rows are fitted side by side, and come out as one after another."""

from __future__ import annotations

import math
import threading

from gridspark.operators import forecast as fc


def test_horizons_are_fitted_side_by_side(spark, make, monkeypatch):
    df = make([100 + 10 * math.sin(i / 7) + i % 5 for i in range(700)]).withColumnRenamed("value", "load_mw")
    met = threading.Barrier(2)

    class Watched:
        def __init__(self, features, label):
            self.inner = fc.linear_pipeline(features[:2], label)

        def fit(self, rows):
            assert rows.rdd.getNumPartitions() == 1
            if fc.SIDE_BY_SIDE_ROWS:
                met.wait(120)  # broken, unless another horizon comes here meanwhile
            return self.inner.fit(rows)

    horizons = {"30min": 1, "24hr": 48}
    found = fc.evaluate_horizons(df, "2024-01-12", "2024-01-12", horizons=horizons, make=Watched, model_name="line").collect()
    assert [(r.horizon, r.model) for r in found] == [(h, m) for h in horizons for m in ("Persistence", "line")]
    assert all(r.mae is not None and r.train_rows >= 50 and r.test_rows >= 10 for r in found)
    monkeypatch.setattr(fc, "SIDE_BY_SIDE_ROWS", 0)
    assert fc.evaluate_horizons(df, "2024-01-12", "2024-01-12", horizons=horizons, make=Watched, model_name="line").collect() == found
