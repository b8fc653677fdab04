"""Forecasting features."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.plans import halo_blocks, keyed, positions
from gridspark.plans.skew import HOME

# Lags and rolling windows in half-hour steps.
LOAD_LAGS = (1, 2, 4, 48, 336)
ROLLING = (("load_rolling_mean_4h", "mean", 8), ("load_rolling_std_4h", "std", 8), ("load_rolling_mean_24h", "mean", 48))
# Weather rules.
HDD_BASE, CDD_BASE = 15.5, 22.0
MAX_IRRADIANCE = 1000.0
CUT_IN, RATED = 10.0, 45.0
WEATHER_ROLLING = (("temp_rolling_6h", 12), ("temp_rolling_24h", 48))
# Daylight threshold and wind-chill limits.
DAYLIGHT, CHILL_BELOW, CHILL_WIND = 10.0, 10.0, 4.8


def calendar_features(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Calendar parts of a time and their cyclic encodings."""

    def turn(part, size):
        return F.lit(2 * math.pi) * part / size

    hour, dow, month = F.hour(ts), F.weekday(ts), F.month(ts)
    return df.withColumns(
        {
            "hour": hour,
            "minute": F.minute(ts),
            "day_of_week": dow,
            "day_of_month": F.dayofmonth(ts),
            "month": month,
            "quarter": F.quarter(ts),
            "year": F.year(ts),
            "is_weekend": (dow >= 5).cast("int"),
            "hour_sin": F.sin(turn(hour, 24)),
            "hour_cos": F.cos(turn(hour, 24)),
            "dow_sin": F.sin(turn(dow, 7)),
            "dow_cos": F.cos(turn(dow, 7)),
            "month_sin": F.sin(turn(month, 12)),
            "month_cos": F.cos(turn(month, 12)),
        }
    )


def holiday_flag(df: DataFrame, holidays: DataFrame, ts: str = "ts", day: str = "holiday") -> DataFrame:
    """Add ``is_holiday`` (0/1) from a table of dates.

    A list of days is small, which Spark sees for itself; the days are made unique first.
    """
    days = holidays.select(F.to_date(day).alias("_day")).where(F.col("_day").isNotNull()).distinct().withColumn("_hit", F.lit(1))
    out = df.withColumn("_day", F.to_date(ts)).join(days, "_day", "left")
    return out.withColumn("is_holiday", F.coalesce("_hit", F.lit(0))).drop("_day", "_hit")


def lag_features(df: DataFrame, keys: Sequence[str] = (), ts: str = "ts", value: str = "value", lags: Sequence[int] = LOAD_LAGS, tiebreak: str | None = None, target_rows: int | None = None) -> DataFrame:
    """Add ``load_lag_k``: the value ``k`` rows before."""
    return load_features(df, keys, ts, value, lags, (), tiebreak, target_rows)


def rolling_features(df: DataFrame, keys: Sequence[str] = (), ts: str = "ts", value: str = "value", windows=ROLLING, tiebreak: str | None = None, target_rows: int | None = None) -> DataFrame:
    """Add rolling means and deviations, null until the window is full."""
    return load_features(df, keys, ts, value, (), windows, tiebreak, target_rows)


def load_features(df: DataFrame, keys: Sequence[str] = (), ts: str = "ts", value: str = "value", lags: Sequence[int] = LOAD_LAGS, windows=ROLLING, tiebreak: str | None = None, target_rows: int | None = None) -> DataFrame:
    """Lags and rolling statistics in one pass over the same layout."""
    names = df.columns
    df, keys = keyed(df, keys)
    back = max([*lags, *[size - 1 for _, _, size in windows], 0])
    rows, order = halo_blocks(positions(df, keys, ts, tiebreak, target_rows=target_rows), keys, back, 0, target_rows)
    new = {f"load_lag_{k}": F.lag(value, k).over(order) for k in lags}
    for name, what, size in windows:
        w = order.rowsBetween(1 - size, 0)
        agg = F.avg(value) if what == "mean" else F.stddev_samp(value)
        new[name] = F.when(F.count(value).over(w) == size, agg.over(w))
    return rows.withColumns(new).where(F.col(HOME)).select(*names, *new)


def weather_features(df: DataFrame, keys: Sequence[str] = (), ts: str = "ts", rolling: bool = True, tiebreak: str | None = None, target_rows: int | None = None) -> DataFrame:
    """Degree days, wind chill, solar and wind proxies, daylight, rolling temperatures."""
    t, wind, sun = F.col("temperature_2m"), F.col("wind_speed_10m"), F.col("shortwave_radiation")
    power = F.pow(wind, F.lit(0.16))
    chill = 13.12 + 0.6215 * t - 11.37 * power + 0.3965 * t * power
    cubed = F.pow((wind - CUT_IN) / (RATED - CUT_IN), F.lit(3.0))
    out = df.withColumns(
        {
            "hdd": F.when(t.isNotNull(), F.greatest(HDD_BASE - t, F.lit(0.0))),
            "cdd": F.when(t.isNotNull(), F.greatest(t - CDD_BASE, F.lit(0.0))),
            "wind_chill": F.when((t >= CHILL_BELOW) | (wind <= CHILL_WIND), t).otherwise(chill),
            "solar_capacity_factor": F.when(sun.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), sun / MAX_IRRADIANCE))),
            "wind_power_proxy": F.when(wind < CUT_IN, 0.0).when(wind.isNotNull(), F.least(cubed, F.lit(1.0))),
            "is_daylight": F.coalesce((sun > DAYLIGHT).cast("int"), F.lit(0)),
        }
    )
    if not rolling:
        return out
    names = out.columns
    rows, keys = keyed(out, keys)
    back = max(size for _, size in WEATHER_ROLLING) - 1
    rows, order = halo_blocks(positions(rows, keys, ts, tiebreak, target_rows=target_rows), keys, back, 0, target_rows)
    new = {name: F.avg("temperature_2m").over(order.rowsBetween(1 - size, 0)) for name, size in WEATHER_ROLLING}
    return rows.withColumns(new).where(F.col(HOME)).select(*names, *new)


def time_split(df: DataFrame, train_end: str, test_start: str, ts: str = "ts") -> tuple[DataFrame, DataFrame]:
    """Rows before ``train_end`` and rows from ``test_start``; the days between belong to neither."""
    end, start = (F.lit(d).cast(df.schema[ts].dataType) for d in (train_end, test_start))
    return df.where(F.col(ts) < end), df.where(F.col(ts) >= start)


def persistence_forecast(df: DataFrame, keys: Sequence[str] = (), ts: str = "ts", value: str = "value", steps: int = 48, tiebreak: str | None = None, target_rows: int | None = None) -> DataFrame:
    """Add ``forecast``: the value ``steps`` rows before."""
    out = load_features(df, keys, ts, value, (steps,), (), tiebreak, target_rows)
    return out.withColumnRenamed(f"load_lag_{steps}", "forecast")
