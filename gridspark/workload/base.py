"""Registration of queries, and frames made by portable SQL over the test tables.

A binding is SQL with ``{table}`` placeholders that both Spark and the checking engine accept, so the
two sides start from the same rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def plain(binding: str) -> str:
    """The binding as SQL over the registered views."""
    return re.sub(r"\{(\w+)\}", r"\1", binding)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def frame(spark: SparkSession, sf: str, binding: str) -> DataFrame:
    """The binding as a Spark frame."""
    used = set(re.findall(r"\{(\w+)\}", binding))
    return spark.sql(binding, **{t: table(spark, sf, t) for t in used})


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Result form: rounded doubles, naive timestamps, wide integers."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            # Adding zero turns a rounded -0.0 into 0.0.
            c = F.round(c, digits) + F.lit(0.0)
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        out.append(c.alias(f.name))
    return df.select(*out)


def check(name: str, sql: str | None = None, digits: int = 6):
    """Register ``fn(spark, sf)`` under ``name``, with its SQL counterpart if there is one."""

    def register(fn):
        QUERIES[name] = lambda spark, sf: tidy(fn(spark, sf), digits)
        if sql is not None:
            SQL[name] = plain(sql)
        return fn

    return register


# --- shared bindings --------------------------------------------------------------------------

HALF_HOUR = "date_trunc('hour', ts) + CASE WHEN minute(ts) >= 30 THEN INTERVAL '30' MINUTE ELSE INTERVAL '0' MINUTE END"

# Irregular series with nulls: one per event type.
IRREGULAR = """SELECT event_type AS key, event_id, ts,
       CASE WHEN event_id % 13 = 0 THEN NULL ELSE value END AS value FROM {events}"""
# The same without nulls, with spikes and zeros.
SPIKY = """SELECT event_type AS key, event_id, ts,
       CASE WHEN event_id % 997 = 0 THEN value * 20 WHEN event_id % 41 = 0 THEN 0.0 ELSE value END AS value FROM {events}"""
# Half-hourly totals per event type; empty half-hours are natural gaps.
HALF_HOURLY = f"""SELECT event_type AS key, {HALF_HOUR} AS ts, ROUND(SUM(value), 2) AS value FROM {{events}} GROUP BY 1, 2"""
# Daily totals over several years per order priority.
DAILY = """SELECT o_orderpriority AS key, date_trunc('day', o_orderdate) AS ts,
       ROUND(SUM(o_totalprice), 2) AS value FROM {orders} GROUP BY 1, 2"""
# Single orders as an irregular multi-year series per priority.
ORDERS = """SELECT o_orderpriority AS key, o_orderkey, o_orderdate AS ts, o_totalprice AS value FROM {orders}"""
# Hourly weather stand-in per event type.
WEATHER = """SELECT event_type AS key, date_trunc('hour', ts) AS ts, ROUND(SUM(value), 2) / 40 - 3 AS temperature_2m,
       MIN(value) / 3 AS wind_speed_10m, MAX(value) * 3 AS shortwave_radiation FROM {events} GROUP BY 1, 2"""
