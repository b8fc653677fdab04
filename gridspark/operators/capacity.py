"""Ratings, flexibility need and headroom."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: power factor for MVA to MW.
POWER_FACTOR = 0.97


def transformer_ratings(table_2a: DataFrame, table_2b: DataFrame) -> DataFrame:
    """Ratings of 2-winding units and of the HV side of 3-winding units, one row each.

    Units with neither rating are left out; a rating of zero counts as none, as in the source tables.
    """

    def rating(column: str) -> Column:
        return F.nullif(F.col(column).try_cast("double"), F.lit(0.0))

    two = table_2a.select(
        F.col("lv_substation").alias("substation"),
        "hv_substation",
        "lv_substation",
        F.lit("2-winding").alias("type"),
        rating("transformer_rating_mva_winter").alias("rating_mva_winter"),
        rating("transformer_rating_mva_summer").alias("rating_mva_summer"),
    )
    both = F.concat_ws(" / ", F.coalesce("lv_substation_1", F.lit("N/A")), F.coalesce("lv_substation_2", F.lit("N/A")))
    three = table_2b.select(
        F.col("hv_substation").alias("substation"),
        "hv_substation",
        both.alias("lv_substation"),
        F.lit("3-winding").alias("type"),
        rating("transformer_rating_mva_winter_hv").alias("rating_mva_winter"),
        rating("transformer_rating_mva_summer_hv").alias("rating_mva_summer"),
    )
    return two.unionByName(three).where(F.col("rating_mva_winter").isNotNull() | F.col("rating_mva_summer").isNotNull())


def n_minus_1_rating(ratings: DataFrame, by: Sequence[str] = ("substation",), power_factor: float = POWER_FACTOR) -> DataFrame:
    """Capacity left when the largest unit is out, winter and summer, MVA and MW."""
    aggs = []
    for season in ("winter", "summer"):
        mva = F.sum(f"rating_mva_{season}") - F.max(f"rating_mva_{season}")
        aggs += [mva.alias(f"n_minus_1_mva_{season}"), (mva * power_factor).alias(f"n_minus_1_mw_{season}")]
    return ratings.groupBy(*by).agg(F.count("*").alias("units"), *aggs)


def daily_peaks(df: DataFrame, keys: Sequence[str] = (), ts: str = "ts", actual: str = "actual", forecast: str = "forecast", p90: str = "p90") -> DataFrame:
    """Highest actual, forecast and P90 per day."""
    return df.groupBy(*keys, F.to_date(ts).alias("day")).agg(
        F.max(actual).alias("actual_peak"), F.max(forecast).alias("forecast_peak"), F.max(p90).alias("p90_peak")
    )


def flexibility_days(peaks: DataFrame, ratings: DataFrame, on: Sequence[str] = (), rating: str = "n_minus_1_mw_winter") -> DataFrame:
    """Whether each day needs flexibility, whether the load really exceeded, and the margin.

    With no ``on`` columns ``ratings`` must have one row, which is used for all days.
    """
    if on:
        rows = peaks.join(ratings.select(*on, F.col(rating).alias("rating_mw")), list(on))
    else:
        rows = peaks.withColumn("rating_mw", ratings.select(rating).scalar())
    return rows.withColumns(
        {
            "needs_flex": F.coalesce(F.col("p90_peak") > F.col("rating_mw"), F.lit(False)),
            "actual_exceeds": F.coalesce(F.col("actual_peak") > F.col("rating_mw"), F.lit(False)),
            "margin_mw": F.col("rating_mw") - F.col("p90_peak"),
        }
    )


def worst_day(days: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The day in need with the lowest margin (the first on ties)."""
    first = F.min(F.struct("margin_mw", "day"))
    return days.where(F.col("needs_flex")).groupBy(*keys).agg(first.alias("_w")).select(*keys, "_w.day", "_w.margin_mw")


def monthly_need(days: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Days in need, days exceeded and total shortfall per month."""
    short = F.coalesce(F.sum(F.when(F.col("margin_mw") < 0, -F.col("margin_mw"))), F.lit(0.0))
    return days.groupBy(*keys, F.trunc("day", "month").alias("month")).agg(
        F.sum(F.col("needs_flex").cast("long")).alias("days_needing_flex"),
        F.sum(F.col("actual_exceeds").cast("long")).alias("days_exceeding"),
        short.alias("total_shortfall_mw"),
    )


def positive_headroom(df: DataFrame, column: str = "headroom_mw") -> DataFrame:
    """Rows whose headroom reads as a number above zero."""
    return df.withColumn(column, F.col(column).try_cast("double")).where(F.col(column) > 0)


def capacity_alerts(df: DataFrame, ratings: DataFrame, on: Sequence[str], value: str = "value", source: str = "ltds_name", rating: str = "n_minus_1_mw_winter", factor: float = 2.0) -> DataFrame:
    """Substations whose load passes ``factor`` times the rating, or whose rows name several sources."""
    load = df.groupBy(*on).agg(F.max(value).alias("max_load"), F.count_distinct(source).alias("source_names"))
    out = load.join(ratings.select(*on, F.col(rating).alias("rating_mw")), list(on), "left")
    return out.withColumns(
        {
            "over_capacity": F.coalesce(F.col("max_load") > factor * F.col("rating_mw"), F.lit(False)),
            "load_to_rating": F.col("max_load") / F.nullif(F.col("rating_mw"), F.lit(0.0)),
            "mixed_sources": F.col("source_names") > 1,
        }
    )
