"""Features, models, metrics and intervals."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridspark.operators import features as ft
from gridspark.operators import forecast as fc
from gridspark.operators.boosting import fit_predict
from gridspark.operators.quality import fill_gaps
from gridspark.operators.series import regular_grid
from gridspark.workload.base import HALF_HOURLY, IRREGULAR, ORDERS, WEATHER, check, frame, table

K = ["key"]
TB = "event_id"
P = "PARTITION BY key ORDER BY ts, event_id"
PI = 3.141592653589793


@check(
    "calendar_features",
    f"""WITH c AS (SELECT event_id, ts, EXTRACT(hour FROM ts) AS h, isodow(ts) - 1 AS d, EXTRACT(month FROM ts) AS m FROM {{events}})
        SELECT event_id, ts, h AS hour, EXTRACT(minute FROM ts) AS minute, d AS day_of_week, EXTRACT(day FROM ts) AS day_of_month, m AS month, EXTRACT(quarter FROM ts) AS quarter,
               EXTRACT(year FROM ts) AS year, CAST(CASE WHEN d >= 5 THEN 1 ELSE 0 END AS BIGINT) AS is_weekend,
               ROUND(sin(2 * {PI} * h / 24), 6) + 0.0 AS hour_sin, ROUND(cos(2 * {PI} * h / 24), 6) + 0.0 AS hour_cos, ROUND(sin(2 * {PI} * d / 7), 6) + 0.0 AS dow_sin,
               ROUND(cos(2 * {PI} * d / 7), 6) + 0.0 AS dow_cos, ROUND(sin(2 * {PI} * m / 12), 6) + 0.0 AS month_sin, ROUND(cos(2 * {PI} * m / 12), 6) + 0.0 AS month_cos FROM c""",
)
def _(spark, sf):
    return ft.calendar_features(table(spark, sf, "events").select("event_id", "ts"))


# Every day with a very large order is taken as a holiday.
HOLIDAYS = "SELECT DISTINCT CAST(o_orderdate AS DATE) AS holiday FROM {orders} WHERE o_totalprice > 300000"


@check("holiday_flag", f"SELECT o_orderkey, CAST(CASE WHEN CAST(o_orderdate AS DATE) IN (SELECT holiday FROM ({HOLIDAYS}) h) THEN 1 ELSE 0 END AS BIGINT) AS is_holiday FROM {{orders}}")
def _(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return ft.holiday_flag(rows, frame(spark, sf, HOLIDAYS), "o_orderdate").select("o_orderkey", "is_holiday")


_LAGS = ", ".join(f"ROUND(LAG(value, {k}) OVER w, 6) AS load_lag_{k}" for k in ft.LOAD_LAGS)


@check("lag_features", f"SELECT key, event_id, ts, ROUND(value, 6) AS value, {_LAGS} FROM ({IRREGULAR}) x WINDOW w AS ({P})")
def _(spark, sf):
    return ft.lag_features(frame(spark, sf, IRREGULAR), K, tiebreak=TB)


def _rolled(name: str, what: str, size: int) -> str:
    over = f"OVER ({P} ROWS BETWEEN {size - 1} PRECEDING AND CURRENT ROW)"
    agg = "AVG" if what == "mean" else "STDDEV_SAMP"
    return f"CASE WHEN COUNT(value) {over} = {size} THEN ROUND({agg}(value) {over}, 6) END AS {name}"


@check("rolling_features", f"SELECT key, event_id, ts, ROUND(value, 6) AS value, {', '.join(_rolled(*r) for r in ft.ROLLING)} FROM ({IRREGULAR}) x")
def _(spark, sf):
    return ft.rolling_features(frame(spark, sf, IRREGULAR), K, tiebreak=TB)


@check(
    "complete_features",
    f"""WITH f AS (SELECT key, event_id, value, {_LAGS}, {', '.join(_rolled(*r) for r in ft.ROLLING)} FROM (SELECT event_type AS key, event_id, ts, value FROM {{events}}) x WINDOW w AS ({P}))
        SELECT key, event_id, ROUND(load_lag_336, 6) AS load_lag_336, load_rolling_mean_24h FROM f WHERE load_lag_336 IS NOT NULL AND load_rolling_mean_24h IS NOT NULL""",
)
def _(spark, sf):
    rows = frame(spark, sf, "SELECT event_type AS key, event_id, ts, value FROM {events}")
    return ft.load_features(rows, K, tiebreak=TB).dropna().select("key", "event_id", "load_lag_336", "load_rolling_mean_24h")


@check(
    "weather_features",
    f"""WITH w AS ({WEATHER}), c AS (SELECT *, 13.12 + 0.6215 * temperature_2m - 11.37 * power(wind_speed_10m, 0.16) + 0.3965 * temperature_2m * power(wind_speed_10m, 0.16) AS chill FROM w)
        SELECT key, CAST(ts AS TIMESTAMP) AS ts, ROUND(temperature_2m, 10) AS temperature_2m, ROUND(wind_speed_10m, 10) AS wind_speed_10m, ROUND(shortwave_radiation, 10) AS shortwave_radiation,
          ROUND(GREATEST(15.5 - temperature_2m, 0), 10) + 0.0 AS hdd, ROUND(GREATEST(temperature_2m - 22.0, 0), 10) + 0.0 AS cdd,
          ROUND(CASE WHEN temperature_2m >= 10 OR wind_speed_10m <= 4.8 THEN temperature_2m ELSE chill END, 10) AS wind_chill,
          ROUND(GREATEST(0.0, LEAST(1.0, shortwave_radiation / 1000)), 10) AS solar_capacity_factor,
          ROUND(CASE WHEN wind_speed_10m < 10 THEN 0.0 ELSE LEAST(power((wind_speed_10m - 10) / 35, 3), 1.0) END, 10) AS wind_power_proxy,
          CAST(CASE WHEN shortwave_radiation > 10 THEN 1 ELSE 0 END AS BIGINT) AS is_daylight,
          ROUND(AVG(temperature_2m) OVER (PARTITION BY key ORDER BY ts ROWS BETWEEN 11 PRECEDING AND CURRENT ROW), 10) AS temp_rolling_6h,
          ROUND(AVG(temperature_2m) OVER (PARTITION BY key ORDER BY ts ROWS BETWEEN 47 PRECEDING AND CURRENT ROW), 10) AS temp_rolling_24h FROM c""",
    digits=10,
)
def _(spark, sf):
    return ft.weather_features(frame(spark, sf, WEATHER), K)


@check(
    "time_split",
    """SELECT event_id, CASE WHEN ts < TIMESTAMP '2024-01-20' THEN 'train' ELSE 'test' END AS part FROM {events} WHERE ts < TIMESTAMP '2024-01-20' OR ts >= TIMESTAMP '2024-01-21'""",
)
def _(spark, sf):
    train, test = ft.time_split(table(spark, sf, "events"), "2024-01-20", "2024-01-21")
    return train.select("event_id", F.lit("train").alias("part")).union(test.select("event_id", F.lit("test").alias("part")))


@check("persistence_forecast", f"SELECT key, event_id, ts, ROUND(value, 6) AS value, ROUND(LAG(value, 48) OVER ({P}), 6) AS forecast FROM ({IRREGULAR}) x")
def _(spark, sf):
    return ft.persistence_forecast(frame(spark, sf, IRREGULAR), K, tiebreak=TB)


# --- metrics ----------------------------------------------------------------------------------

SCORED = """SELECT o_orderpriority AS model, o_orderkey, o_orderdate AS ts, o_totalprice AS actual,
   o_totalprice * (1 + ((o_orderkey * 37) % 21 - 10) / 50.0D) AS forecast FROM {orders}"""
SCORED_SQL = SCORED.replace("50.0D", "50.0::DOUBLE")
METRICS_SQL = f"""SELECT model, AVG(ABS(actual - forecast)) AS mae, sqrt(AVG(power(actual - forecast, 2))) AS rmse, 100 * AVG(ABS((actual - forecast) / NULLIF(actual, 0))) AS mape,
   1 - SUM(power(actual - forecast, 2)) / (VAR_POP(actual) * COUNT(*)) AS r2 FROM ({SCORED_SQL}) s GROUP BY 1"""


@check("forecast_metrics", f"SELECT model, ROUND(mae, 4) AS mae, ROUND(rmse, 4) AS rmse, ROUND(mape, 4) AS mape, ROUND(r2, 4) AS r2 FROM ({METRICS_SQL}) m", digits=4)
def _(spark, sf):
    return fc.forecast_metrics(frame(spark, sf, SCORED), keys=["model"])


@check("best_model", f"SELECT arg_min(model, rmse) AS best_model, ROUND(MIN(rmse), 4) AS rmse FROM ({METRICS_SQL}) m", digits=4)
def _(spark, sf):
    return fc.best_model(fc.forecast_metrics(frame(spark, sf, SCORED), keys=["model"]))


@check(
    "skill_scores",
    f"""WITH m AS ({METRICS_SQL}) SELECT 'all' AS horizon, m.model, ROUND(100 * (1 - m.rmse / b.rmse), 4) AS skill FROM m, m b WHERE b.model = '1-URGENT' AND m.model <> '1-URGENT'""",
    digits=4,
)
def _(spark, sf):
    metrics = fc.forecast_metrics(frame(spark, sf, SCORED), keys=["model"]).withColumn("horizon", F.lit("all"))
    return fc.skill_scores(metrics, "1-URGENT")


@check(
    "residual_bands",
    f"""WITH s AS ({SCORED_SQL}), b AS (SELECT EXTRACT(hour FROM ts) AS h, quantile_cont(actual - forecast, 0.1) AS a, quantile_cont(actual - forecast, 0.5) AS m, quantile_cont(actual - forecast, 0.9) AS z
           FROM s WHERE ts < TIMESTAMP '1998-01-01' GROUP BY 1)
        SELECT o_orderkey, ROUND(forecast + a, 6) AS p10, ROUND(forecast + m, 6) AS p50, ROUND(forecast + z, 6) AS p90 FROM s LEFT JOIN b ON b.h = EXTRACT(hour FROM s.ts) WHERE ts >= TIMESTAMP '1998-01-01'""",
)
def _(spark, sf):
    train, test = ft.time_split(frame(spark, sf, SCORED), "1998-01-01", "1998-01-01")
    return fc.residual_bands(train, test, "actual").select("o_orderkey", "p10", "p50", "p90")


@check(
    "interval_coverage",
    f"SELECT model, ROUND(AVG(CASE WHEN actual BETWEEN forecast * 0.9 AND forecast * 1.1 THEN 1.0 ELSE 0.0 END), 6) AS coverage FROM ({SCORED_SQL}) s GROUP BY 1",
)
def _(spark, sf):
    rows = frame(spark, sf, SCORED).withColumns({"p10": F.col("forecast") * 0.9, "p90": F.col("forecast") * 1.1})
    return fc.interval_coverage(rows, keys=["model"])


PERSISTENCE = " UNION ALL ".join(
    f"""SELECT key, '{label}' AS horizon, 'Persistence' AS model, ROUND(AVG(ABS(t - p)), 4) AS mae, ROUND(sqrt(AVG(power(t - p, 2))), 4) AS rmse,
        ROUND(100 * AVG(ABS((t - p) / NULLIF(t, 0))), 4) AS mape, ROUND(1 - SUM(power(t - p, 2)) / (VAR_POP(t) * COUNT(*)), 4) AS r2
        FROM (SELECT key, ts, LEAD(load_mw, {steps - 1}) OVER w AS t, LAG(load_mw, {48 - (steps - 1)}) OVER w AS p FROM (SELECT key, ts, o_orderkey, value AS load_mw FROM ({ORDERS}) o) x
              WINDOW w AS (PARTITION BY key ORDER BY ts, o_orderkey)) y
        WHERE ts >= TIMESTAMP '1999-01-01' AND t IS NOT NULL AND p IS NOT NULL GROUP BY key"""
    for label, steps in fc.HORIZONS.items()
)


@check("persistence_by_horizon", PERSISTENCE, digits=4)
def _(spark, sf):
    rows = frame(spark, sf, ORDERS).withColumnRenamed("value", "load_mw")
    return fc.persistence_by_horizon(rows, "1999-01-01", K, tiebreak="o_orderkey")


# One round of full rate on a feature of few values forecasts the mean of the training rows with the same value.
BY_KEY = " UNION ALL ".join(
    f"""SELECT key, '{label}' AS horizon, ts, t, p, EXTRACT(dow FROM tt) AS dow FROM
        (SELECT key, ts, LEAD(load_mw, {steps - 1}) OVER w AS t, LEAD(ts, {steps - 1}) OVER w AS tt, LAG(load_mw, {48 - (steps - 1)}) OVER w AS p
         FROM (SELECT key, ts, o_orderkey, value AS load_mw FROM ({ORDERS}) o) x WINDOW w AS (PARTITION BY key ORDER BY ts, o_orderkey)) y
        WHERE t IS NOT NULL AND p IS NOT NULL"""
    for label, steps in fc.HORIZONS.items()
)


def _metrics_sql(forecast: str, model: str) -> str:
    e = f"t - {forecast}"
    return f"""SELECT key, horizon, '{model}' AS model, ROUND(AVG(ABS({e})), 3) AS mae, ROUND(sqrt(AVG(power({e}, 2))), 3) AS rmse, ROUND(100 * AVG(ABS(({e}) / NULLIF(t, 0))), 3) AS mape,
        ROUND(1 - SUM(power({e}, 2)) / (VAR_POP(t) * COUNT(*)), 3) AS r2 FROM s GROUP BY key, horizon"""


@check(
    "horizon_evaluation_by_key",
    f"""WITH r AS ({BY_KEY}), f AS (SELECT key, horizon, dow, AVG(t) AS f FROM r WHERE ts < TIMESTAMP '1998-01-01' GROUP BY 1, 2, 3),
        s AS (SELECT r.*, f.f FROM r JOIN f USING (key, horizon, dow) WHERE ts >= TIMESTAMP '1999-01-01'),
        m AS ({_metrics_sql('p', 'Persistence')} UNION ALL {_metrics_sql('f', 'Gradient Boosting')}),
        n AS (SELECT key, horizon, COUNT(*) FILTER (WHERE ts < TIMESTAMP '1998-01-01') AS train_rows, COUNT(*) FILTER (WHERE ts >= TIMESTAMP '1999-01-01') AS test_rows FROM r GROUP BY 1, 2)
        SELECT m.*, train_rows, test_rows FROM m JOIN n USING (key, horizon)""",
    digits=3,
)
def _(spark, sf):
    rows = frame(spark, sf, ORDERS).withColumnRenamed("value", "load_mw")
    return fc.evaluate_horizons_by_key(rows, K, "1998-01-01", "1999-01-01", tiebreak="o_orderkey", features=["day_of_week"], rounds=1, rate=1.0)


@check("boosting_by_key", "SELECT l_returnflag, l_linenumber, ROUND(AVG(l_extendedprice), 4) AS forecast FROM {lineitem} GROUP BY 1, 2", digits=4)
def _(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_returnflag", "l_linenumber", F.col("l_extendedprice").cast("double").alias("price"), F.lit(True).alias("known"))
    out = fit_predict(rows, ["l_returnflag"], ["l_linenumber"], "price", "known", rounds=1, rate=1.0, leaf_rows=1)
    return out.groupBy("l_returnflag", "l_linenumber").agg(F.max("forecast").alias("forecast"))


@check(
    "boosting_bands_by_key",
    f"""WITH o AS (SELECT *, EXTRACT(dow FROM ts) AS dow FROM ({ORDERS}) x), f AS (SELECT key, dow, AVG(value) AS f FROM o WHERE ts < TIMESTAMP '1998-01-01' GROUP BY 1, 2),
        s AS (SELECT o.*, f.f FROM o JOIN f USING (key, dow)),
        b AS (SELECT key, EXTRACT(hour FROM ts) AS h, quantile_cont(value - f, 0.1) AS a, quantile_cont(value - f, 0.5) AS m, quantile_cont(value - f, 0.9) AS z FROM s WHERE ts < TIMESTAMP '1998-01-01' GROUP BY 1, 2)
        SELECT o_orderkey, ROUND(f, 3) AS forecast, ROUND(f + a, 3) AS p10, ROUND(f + m, 3) AS p50, ROUND(f + z, 3) AS p90 FROM s LEFT JOIN b ON b.key = s.key AND b.h = EXTRACT(hour FROM s.ts) WHERE ts >= TIMESTAMP '1998-01-01'""",
    digits=3,
)
def _(spark, sf):
    rows = ft.calendar_features(frame(spark, sf, ORDERS).withColumnRenamed("value", "load_mw"), "ts")
    rows = rows.select("key", "ts", "o_orderkey", "load_mw", "day_of_week", (F.col("ts") < F.lit("1998-01-01").cast(rows.schema["ts"].dataType)).alias("known"))
    out = fit_predict(rows, K, ["day_of_week"], "load_mw", "known", rounds=1, rate=1.0)
    return fc.residual_bands(out.where("known"), out.where("not known"), keys=K).select("o_orderkey", "forecast", "p10", "p50", "p90")


# --- fitted models: no SQL counterpart --------------------------------------------------------


def model_rows(spark, sf):
    """Half-hourly load of all event types together, filled, with features."""
    load = frame(spark, sf, HALF_HOURLY).groupBy("ts").agg(F.sum("value").alias("load_mw"))
    load = load.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    load = fill_gaps(regular_grid(load, value="load_mw"), "linear", value="load_mw")
    return ft.calendar_features(ft.load_features(load, value="load_mw").dropna())


FEATURES = [*fc.CALENDAR, "load_lag_1", "load_lag_2", "load_lag_4", "load_lag_48", "load_lag_336", "load_rolling_mean_4h", "load_rolling_std_4h", "load_rolling_mean_24h"]
TRAIN_END, TEST_START = "2024-01-24", "2024-01-24"


def _scored(spark, sf, pipeline):
    train, test = ft.time_split(model_rows(spark, sf), TRAIN_END, TEST_START)
    # Several training passes read these rows; they are kept while the model is fitted.
    kept = train.persist()
    try:
        model = pipeline(FEATURES).fit(kept)
    finally:
        kept.unpersist()
    return model, train, test


@check("linear_regression_forecast")
def _(spark, sf):
    model, _, test = _scored(spark, sf, fc.linear_pipeline)
    return fc.predict(model, test).select("ts", "load_mw", "forecast")


@check("random_forest_importances")
def _(spark, sf):
    model, train, _ = _scored(spark, sf, fc.forest_pipeline)
    return fc.feature_importances(model, FEATURES, train)


@check("gradient_boosting_bands")
def _(spark, sf):
    model, train, test = _scored(spark, sf, fc.boosting_pipeline)
    return fc.residual_bands(fc.predict(model, train), fc.predict(model, test)).select("ts", "load_mw", "forecast", "p10", "p50", "p90")


@check("horizon_evaluation")
def _(spark, sf):
    rows = model_rows(spark, sf).select("ts", "load_mw")
    return fc.evaluate_horizons(rows, TRAIN_END, TEST_START)


# --- fitted models where SQL knows the fit ----------------------------------------------------

PARTS = "SELECT l_orderkey, l_linenumber, CAST(l_quantity AS DOUBLE) AS size, CAST(l_extendedprice AS DOUBLE) AS load_mw FROM {lineitem}"


def _fitted(spark, sf, pipeline, **args):
    rows = frame(spark, sf, PARTS)
    out = fc.predict(pipeline(["size"], **args).fit(rows), rows)
    return out.groupBy("size").agg(F.max("forecast").alias("forecast"))


@check(
    "least_squares_line",
    f"""WITH p AS ({PARTS}), f AS (SELECT regr_slope(load_mw, size) AS a, regr_intercept(load_mw, size) AS b FROM p)
        SELECT size, ROUND(ANY_VALUE(a) * size + ANY_VALUE(b), 2) AS forecast FROM p, f GROUP BY size""",
    digits=2,
)
def _(spark, sf):
    return _fitted(spark, sf, fc.linear_pipeline)


# A tree with a leaf for every value of its feature forecasts the mean of each.
LEAVES = f"SELECT size, ROUND(AVG(load_mw), 4) AS forecast FROM ({PARTS}) p GROUP BY size"


@check("forest_single_tree", LEAVES, digits=4)
def _(spark, sf):
    return _fitted(spark, sf, fc.forest_pipeline, trees=1, bins=64, bootstrap=False)


@check("boosting_single_round", LEAVES, digits=4)
def _(spark, sf):
    return _fitted(spark, sf, fc.boosting_pipeline, rounds=1, depth=15, rate=1.0, bins=64)
