"""Boosting of many series at once against trees grown by definition."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridspark.operators import forecast as fc
from gridspark.operators.boosting import boost, fit_predict


def by_definition(b, y, train, rounds, depth, rate, bins, leaf_rows):
    forecast = [sum(v for v, t in zip(y, train) if t) / sum(train)] * len(y)
    for _ in range(rounds):
        r = [v - f for v, f in zip(y, forecast)]
        leaves = [list(range(len(y)))]
        for _ in range(depth):
            grown = []
            for rows in leaves:
                best = (1e-9, None)
                for f in range(len(b[0])):
                    for cut in range(bins):
                        left = [r[i] for i in rows if train[i] and b[i][f] <= cut]
                        right = [r[i] for i in rows if train[i] and b[i][f] > cut]
                        if len(left) >= leaf_rows and len(right) >= leaf_rows:
                            gain = sum(left) ** 2 / len(left) + sum(right) ** 2 / len(right) - (sum(left) + sum(right)) ** 2 / (len(left) + len(right))
                            if gain > best[0] + 1e-9:
                                best = (gain, (f, cut))
                if best[1] is None:
                    grown.append(rows)
                else:
                    f, cut = best[1]
                    grown += [[i for i in rows if b[i][f] <= cut], [i for i in rows if b[i][f] > cut]]
            leaves = grown
        for rows in leaves:
            learned = [r[i] for i in rows if train[i]]
            for i in rows:
                forecast[i] += rate * sum(learned) / max(len(learned), 1)
    return forecast


def test_one_series_by_definition():
    rng = random.Random(1)
    for depth, rounds, leaf in [(1, 1, 1), (3, 2, 3), (2, 4, 5)]:
        b = [[rng.randrange(6), rng.randrange(4), 0] for _ in range(70)]
        y = [10 * x[0] + 3 * (x[1] > 1) * x[0] + rng.random() for x in b]
        train = [rng.random() < 0.7 for _ in b]
        got = boost(np.array(b), np.array(y), np.array(train), rounds, depth, 0.5, 8, leaf)
        assert got == pytest.approx(by_definition(b, y, train, rounds, depth, 0.5, 8, leaf))


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(2)
    out = []
    for key, n in (("a", 300), ("b", 40), ("c", 5), ("d", 4)):
        for i in range(n):
            x, z = rng.randint(0, 40), rng.choice([1.5, 2.5, 3.5])
            out.append((key, i, x, z, x * x + 8.0 * (z > 2) * x + rng.randint(0, 3), key != "d" and i % 4 > 0))
    return spark.createDataFrame(out, "key string, i long, x int, z double, y double, train boolean").repartition(3)


def found(df):
    return {(r["key"], r["i"]): r["forecast"] for r in df.collect()}


def test_large_series_get_the_same_trees(rows):
    args = dict(rounds=3, depth=3, rate=0.5, bins=16)
    one = found(fit_predict(rows, ["key"], ["x", "z"], "y", "train", **args))
    spread = found(fit_predict(rows, ["key"], ["x", "z"], "y", "train", large_rows=0, **args))
    mixed = found(fit_predict(rows, ["key"], ["x", "z"], "y", "train", large_rows=50, **args))
    assert len(one) == rows.count() and {k for k, v in one.items() if v is None} == {("d", i) for i in range(4)}
    for other in (spread, mixed):
        assert set(other) == set(one)
        assert all(v is None and other[k] is None or other[k] == pytest.approx(v) for k, v in one.items())


def test_more_rounds_fit_better(rows):
    errors = []
    for rounds in (1, 30):
        out = fit_predict(rows, ["key"], ["x", "z"], "y", "train", rounds=rounds, depth=3, rate=0.3)
        errors.append(out.where("key = 'a' and train").agg(F.avg(F.abs(F.col("y") - F.col("forecast")))).first()[0])
    assert errors[1] < errors[0] / 8


def test_evaluation_of_each_key_is_that_of_the_series_alone(spark):
    rng = random.Random(3)
    start = datetime(2024, 1, 1)
    data = defaultdict(list)
    for key, days in (("long", 40), ("short", 3)):
        for i in range(48 * days):
            data[key].append((key, start + timedelta(minutes=30 * i), 50 + 20 * ((i % 48) // 12) + rng.randint(0, 4) * 1.0))
    df = spark.createDataFrame([r for rs in data.values() for r in rs], "site string, ts timestamp_ntz, load_mw double")
    args = dict(train_end="2024-02-01", test_start="2024-02-01", horizons={"1hr": 2, "24hr": 48}, rounds=2, depth=3, rate=0.5)
    got = {(r["site"], r["horizon"], r["model"]): r for r in fc.evaluate_horizons_by_key(df, ["site"], **args).collect()}
    assert len(got) == 4  # the short series has no complete rows: its rolling values and lags reach further back than it
    alone = fc.evaluate_horizons_by_key(df.where("site = 'long'").drop("site"), [], **args).collect()
    for r in alone:
        assert r.asDict() == pytest.approx({k: v for k, v in got["long", r["horizon"], r["model"]].asDict().items() if k != "site"})
        assert r["model"] == "Persistence" or r["r2"] > 0.5
    few = fc.evaluate_horizons_by_key(df, ["site"], **(args | {"features": ["hour"], "train_end": "2024-01-02 12:00:00", "test_start": "2024-01-03"})).collect()
    short = {(r["horizon"], r["model"]): r for r in few if r["site"] == "short"}
    assert short["1hr", "Gradient Boosting"]["mae"] is None and short["1hr", "Persistence"]["mae"] is not None and short["1hr", "Persistence"]["train_rows"] < 50
