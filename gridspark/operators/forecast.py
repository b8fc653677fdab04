"""Forecast models on Spark ML, their metrics, intervals and multi-horizon evaluation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.operators.boosting import fit_predict
from gridspark.operators.features import calendar_features, load_features, time_split
from gridspark.plans import exact_quantiles, halo_blocks, keyed, positions
from gridspark.plans.skew import HOME
from gridspark.sources.staging import staged

SEED = 42
# Horizons in half-hour steps, and the fewest rows worth evaluating.
HORIZONS = {"30min": 1, "1hr": 2, "6hr": 12, "24hr": 48}
MIN_TRAIN, MIN_TEST = 50, 10
# Rows that a leaf needs at least: nodes of fewer than ten rows are not split.
LEAF_ROWS = 5
#: Training rows of one task of a fit, at least; rows up to which horizons are fitted side by side, and how many at once.
FIT_ROWS = 20_000
SIDE_BY_SIDE_ROWS, MAX_AT_ONCE = 1_000_000, 4


def _assembled(features: Sequence[str], output: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=output, handleInvalid="skip")


def linear_pipeline(features: Sequence[str], label: str = "load_mw") -> Pipeline:
    """Least squares on standardised features."""
    scale = StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True)
    fit = LinearRegression(labelCol=label, featuresCol="features", predictionCol="forecast")
    return Pipeline(stages=[_assembled(features, "raw_features"), scale, fit])


def forest_pipeline(features: Sequence[str], label: str = "load_mw", trees: int = 100, depth: int = 15, bins: int = 32, bootstrap: bool = True, seed: int = SEED) -> Pipeline:
    fit = RandomForestRegressor(
        labelCol=label, featuresCol="features", predictionCol="forecast", numTrees=trees, maxDepth=depth, minInstancesPerNode=LEAF_ROWS, maxBins=bins, bootstrap=bootstrap, seed=seed
    )
    return Pipeline(stages=[_assembled(features), fit])


def boosting_pipeline(features: Sequence[str], label: str = "load_mw", rounds: int = 100, depth: int = 6, rate: float = 0.1, bins: int = 32, seed: int = SEED) -> Pipeline:
    fit = GBTRegressor(
        labelCol=label, featuresCol="features", predictionCol="forecast", maxIter=rounds, maxDepth=depth, minInstancesPerNode=LEAF_ROWS, maxBins=bins, stepSize=rate, seed=seed
    )
    return Pipeline(stages=[_assembled(features), fit])


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Rows with a ``forecast`` column."""
    return model.transform(df).select(*df.columns, "forecast")


def feature_importances(model: PipelineModel, features: Sequence[str], df: DataFrame) -> DataFrame:
    """``(feature, importance)`` of a fitted tree model, highest first."""
    values = model.stages[-1].featureImportances.toArray()
    rows = [(f, float(v)) for f, v in zip(features, values)]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def forecast_metrics(df: DataFrame, actual: str = "actual", forecast: str = "forecast", keys: Sequence[str] = ()) -> DataFrame:
    """MAE, RMSE, MAPE % and R2 in one aggregate.

    R2 needs the mean of the actuals; sum((y - mean)^2) is the population variance times the count.
    """
    rows = df.where(F.col(actual).isNotNull() & F.col(forecast).isNotNull())
    y, e = F.col(actual), F.col(actual) - F.col(forecast)
    return rows.groupBy(*keys).agg(
        F.avg(F.abs(e)).alias("mae"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        (100 * F.avg(F.abs(e / F.nullif(y, F.lit(0.0))))).alias("mape"),
        (1 - F.sum(e * e) / F.nullif(F.var_pop(y) * F.count("*"), F.lit(0.0))).alias("r2"),
    )


def best_model(metrics: DataFrame, model: str = "model") -> DataFrame:
    """Model with the lowest RMSE."""
    return metrics.agg(F.min_by(model, F.struct("rmse", model)).alias("best_model"), F.min("rmse").alias("rmse"))


def skill_scores(metrics: DataFrame, baseline: str = "Persistence", keys: Sequence[str] = ("horizon",)) -> DataFrame:
    """Improvement of RMSE over the baseline in percent."""
    base = metrics.where(F.col("model") == baseline).select(*keys, F.col("rmse").alias("_base"))
    rows = metrics.where(F.col("model") != baseline).join(base, list(keys))
    return rows.select(*keys, "model", (100 * (1 - F.col("rmse") / F.nullif(F.col("_base"), F.lit(0.0)))).alias("skill"))


def residual_bands(train: DataFrame, forecasts: DataFrame, actual: str = "load_mw", forecast: str = "forecast", ts: str = "ts", keys: Sequence[str] = ()) -> DataFrame:
    """P10 / P50 / P90 of a point forecast: the forecast plus training-residual quantiles of its hour.

    Spark ML has no quantile loss; this gives intervals from the residuals instead.
    """
    by = [*keys, "_hour"]
    residuals = train.select(*keys, F.hour(ts).alias("_hour"), (F.col(actual) - F.col(forecast)).alias("_r"))
    bands = exact_quantiles(residuals, by, "_r", {"_p10": 0.1, "_p50": 0.5, "_p90": 0.9})
    rows = forecasts.withColumn("_hour", F.hour(ts)).join(bands, by, "left")
    return rows.withColumns({p: F.col(forecast) + F.col(f"_{p}") for p in ("p10", "p50", "p90")}).drop("_hour", "_p10", "_p50", "_p90")


def interval_coverage(df: DataFrame, actual: str = "actual", low: str = "p10", high: str = "p90", keys: Sequence[str] = ()) -> DataFrame:
    """Share of actuals inside the interval."""
    inside = F.coalesce(F.col(actual).between(F.col(low), F.col(high)), F.lit(False))
    return df.groupBy(*keys).agg(F.avg(inside.cast("double")).alias("coverage"))


def horizon_frame(df: DataFrame, steps: int, keys: Sequence[str] = (), ts: str = "ts", value: str = "load_mw", tiebreak: str | None = None, target_rows: int | None = None, at_most: int | None = None) -> DataFrame:
    """Rows with ``target`` (the value ``steps - 1`` rows on), its time, and ``persist`` (48 rows before it)."""
    names = df.columns
    rows, keys = keyed(df, keys)
    shift = steps - 1
    rows, order = halo_blocks(positions(rows, keys, ts, tiebreak, target_rows=target_rows, at_most=at_most), keys, max(48 - shift, 0), max(shift, shift - 48), target_rows)
    return (
        rows.withColumns(
            {
                "target": F.lead(value, shift).over(order),
                "target_ts": F.lead(ts, shift).over(order),
                "persist": F.lag(value, 48 - shift).over(order),
            }
        )
        .where(F.col(HOME))
        .select(*names, "target", "target_ts", "persist")
    )


def persistence_by_horizon(df: DataFrame, test_start: str, keys: Sequence[str] = (), ts: str = "ts", value: str = "load_mw", horizons: Mapping[str, int] = HORIZONS, tiebreak: str | None = None, target_rows: int | None = None) -> DataFrame:
    """Persistence metrics per horizon over the test period; all horizons share one layout and one pass."""
    asked = list(keys)
    rows, keys = keyed(df, keys)
    pick = list(dict.fromkeys([*keys, ts, value, *([tiebreak] if tiebreak else [])]))
    shifts = {label: steps - 1 for label, steps in horizons.items()}
    back = max(max(48 - s, 0) for s in shifts.values())
    ahead = max(max(s, s - 48) for s in shifts.values())
    rows = positions(rows.select(*pick), keys, ts, tiebreak, target_rows=target_rows)
    rows, order = halo_blocks(rows, keys, back, ahead, target_rows)
    pairs = []
    for label, shift in shifts.items():
        target = F.lead(value, shift).over(order).alias("target")
        pairs.append(F.struct(F.lit(label).alias("horizon"), target, F.lag(value, 48 - shift).over(order).alias("persist")))
    start = F.lit(test_start).cast(df.schema[ts].dataType)
    cases = rows.withColumn("_pairs", F.array(*pairs)).where(F.col(HOME) & (F.col(ts) >= start))
    cases = cases.select(*asked, F.explode("_pairs").alias("_p")).select(*asked, "_p.*")
    return forecast_metrics(cases, "target", "persist", [*asked, "horizon"]).withColumn("model", F.lit("Persistence"))


def horizon_frames(df: DataFrame, keys: Sequence[str] = (), ts: str = "ts", value: str = "load_mw", horizons: Mapping[str, int] = HORIZONS, tiebreak: str | None = None, target_rows: int | None = None) -> DataFrame:
    """The rows of :func:`horizon_frame` for all horizons, told apart by ``horizon``, from one layout."""
    names = df.columns
    rows, keys = keyed(df, keys)
    shifts = {label: steps - 1 for label, steps in horizons.items()}
    back, ahead = max(max(48 - s, 0) for s in shifts.values()), max(max(s, s - 48) for s in shifts.values())
    rows, order = halo_blocks(positions(rows, keys, ts, tiebreak, target_rows=target_rows), keys, back, ahead, target_rows)
    cases = [
        F.struct(F.lit(label).alias("horizon"), F.lead(value, s).over(order).alias("target"), F.lead(ts, s).over(order).alias("target_ts"), F.lag(value, 48 - s).over(order).alias("persist"))
        for label, s in shifts.items()
    ]
    rows = rows.withColumn("_cases", F.array(*cases)).where(F.col(HOME))
    return rows.select(*names, F.explode("_cases").alias("_case")).select(*names, "_case.*")


# Calendar columns, which describe the target time of a forecast.
CALENDAR = (
    "hour", "minute", "day_of_week", "day_of_month", "month", "quarter", "year", "is_weekend",
    "hour_sin", "hour_cos", "dow_sin", "dow_cos", "month_sin", "month_cos",
)


def evaluate_horizons(df: DataFrame, train_end: str, test_start: str, ts: str = "ts", value: str = "load_mw", horizons: Mapping[str, int] = HORIZONS, make=boosting_pipeline, model_name: str = "Gradient Boosting", **model_args) -> DataFrame:
    """``(horizon, model, mae, rmse, mape, r2, train_rows, test_rows)`` for persistence and a fitted model.

    Lags and rolling values are those known at forecast time. A horizon with fewer than 50 training or 10
    test rows gets no model: its metrics are null. Horizons of few rows are worked on side by side.
    """
    base = load_features(df, (), ts, value)
    lags = [c for c in base.columns if c.startswith("load_lag_") or "rolling" in c]
    # Fitting reads its rows many times over, so they are kept while a horizon is worked on.
    base = base.dropna(subset=[value, *lags]).persist()

    def evaluate(item: tuple[str, int]) -> list[tuple]:
        label, steps = item
        rows = horizon_frame(base, steps, (), ts, value).dropna(subset=["target", "persist"])
        rows = calendar_features(rows, "target_ts").persist()
        try:
            train, test = time_split(rows, train_end, test_start, ts)
            counts = train.count(), test.count()
            # One row of metrics each.
            persistence = (label, "Persistence", *forecast_metrics(test, "target", "persist").first(), *counts)
            metrics = (None,) * 4
            if counts[0] >= MIN_TRAIN and counts[1] >= MIN_TEST:
                # A fit is thousands of short jobs: a task for every few rows would cost more than it works.
                fitted = make([*CALENDAR, *lags], "target", **model_args).fit(train.coalesce(-(-counts[0] // FIT_ROWS)))
                metrics = forecast_metrics(predict(fitted, test), "target", "forecast").first()
            return [persistence, (label, model_name, *metrics, *counts)]
        finally:
            rows.unpersist()

    try:
        # While one horizon's job is planned another's runs; many rows keep all tasks busy by one horizon, and need the room.
        at_once = len(horizons) if base.count() <= SIDE_BY_SIDE_ROWS else 1
        with ThreadPoolExecutor(max(1, min(MAX_AT_ONCE, at_once))) as pool:
            found = [row for part in pool.map(evaluate, horizons.items()) for row in part]
    finally:
        base.unpersist()
    schema = "horizon string, model string, mae double, rmse double, mape double, r2 double, train_rows long, test_rows long"
    return df.sparkSession.createDataFrame(found, schema)


def evaluate_horizons_by_key(
    df: DataFrame,
    keys: Sequence[str],
    train_end: str,
    test_start: str,
    ts: str = "ts",
    value: str = "load_mw",
    horizons: Mapping[str, int] = HORIZONS,
    features: Sequence[str] | None = None,
    tiebreak: str | None = None,
    model_name: str = "Gradient Boosting",
    **model_args,
) -> DataFrame:
    """:func:`evaluate_horizons` for every series: ``(keys, horizon, model, mae, rmse, mape, r2, train_rows, test_rows)``.

    All series and horizons are laid out, fitted and scored together (:mod:`gridspark.operators.boosting`). ``features`` are calendar columns of
    the target time and load features of the forecast time, by default all of them. Null where a horizon of a series
    has fewer than 50 training or 10 test rows: the model's metrics.
    """
    by = [*keys, "horizon"]
    features = None if features is None else list(features)
    lags = []
    base = df.select(*dict.fromkeys([*keys, ts, value, *([tiebreak] if tiebreak else [])]))
    if features is None or set(features) - set(CALENDAR):
        base = load_features(base, keys, ts, value, tiebreak=tiebreak)
        lags = [c for c in base.columns if c.startswith("load_lag_") or "rolling" in c]
        base = base.dropna(subset=[value, *lags])
    rows = horizon_frames(base, keys, ts, value, horizons, tiebreak).dropna(subset=["target", "persist", *keys])
    features = features or [*CALENDAR, *lags]
    rows = calendar_features(rows, "target_ts")
    kind = df.schema[ts].dataType
    rows = rows.withColumns({"_train": F.col(ts) < F.lit(train_end).cast(kind), "_test": F.col(ts) >= F.lit(test_start).cast(kind)}).where("_train or _test")
    rows = staged(rows.select(*by, *features, "target", "persist", "_train", "_test"), "horizon_rows")
    counts = rows.groupBy(*by).agg(F.count_if("_train").alias("train_rows"), F.count_if("_test").alias("test_rows"))
    enough = (F.col("train_rows") >= MIN_TRAIN) & (F.col("test_rows") >= MIN_TEST)
    fitted = fit_predict(rows, by, features, "target", "_train", leaf_rows=LEAF_ROWS, **model_args)
    scored = staged(fitted.where("_test").select(*by, "target", "persist", "forecast"), "horizon_forecasts")
    found = forecast_metrics(scored, "target", "persist", by).withColumn("model", F.lit("Persistence"))
    found = found.unionByName(forecast_metrics(scored, "target", "forecast", by).withColumn("model", F.lit(model_name)))
    both = counts.select("*", F.explode(F.array(F.lit("Persistence"), F.lit(model_name))).alias("model"))
    out = both.join(found, [*by, "model"], "left")
    known = (F.col("model") == "Persistence") | enough
    return out.select(*by, "model", *[F.when(known, F.col(m)).alias(m) for m in ("mae", "rmse", "mape", "r2")], "train_rows", "test_rows")
