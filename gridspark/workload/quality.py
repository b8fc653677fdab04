"""Series building and quality control."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridspark.operators import quality as q
from gridspark.operators import series as s
from gridspark.workload.base import DAILY, HALF_HOURLY, IRREGULAR, SPIKY, check, frame, table

K = ["key"]
TB = "event_id"
P = "PARTITION BY key ORDER BY ts, event_id"


@check(
    "to_series",
    """SELECT event_type, event_id, ts, value FROM (
         SELECT event_type, event_id, TRY_CAST(CASE WHEN event_id % 7 = 0 THEN 'bad' ELSE CAST(ts AS VARCHAR) END AS TIMESTAMP) AS ts,
                ROUND(TRY_CAST(CASE WHEN event_id % 11 = 0 THEN '-' ELSE CAST(value AS VARCHAR) END AS DOUBLE), 6) AS value FROM {events})""",
)
def _(spark, sf):
    text = table(spark, sf, "events").select(
        "event_type",
        "event_id",
        F.when(F.col("event_id") % 7 == 0, "bad").otherwise(F.col("ts").cast("string")).alias("timestamp"),
        F.when(F.col("event_id") % 11 == 0, "-").otherwise(F.col("value").cast("string")).alias("mw"),
    )
    return s.to_series(text, ["event_type", "event_id"], "timestamp", "mw")


GRID_SQL = f"""
  s AS ({HALF_HOURLY}),
  b AS (SELECT key, MIN(ts) AS lo, MAX(ts) AS hi FROM s GROUP BY key),
  g AS (SELECT key, UNNEST(generate_series(lo, hi, INTERVAL 30 MINUTE)) AS ts FROM b),
  grid AS (SELECT g.key, g.ts, s.value FROM g LEFT JOIN s ON s.key = g.key AND s.ts = g.ts)"""


@check("regular_grid", f"WITH {GRID_SQL} SELECT key, ts, ROUND(value, 4) AS value FROM grid", digits=4)
def _(spark, sf):
    events = table(spark, sf, "events")
    # Duplicate times are left in: the operator sums them.
    rows = events.select(F.col("event_type").alias("key"), F.window("ts", "30 minutes")["start"].cast("timestamp_ntz").alias("ts"), "value")
    return s.regular_grid(rows, K, every="30min")


@check(
    "resample_daily",
    """WITH s AS (""" + IRREGULAR + """),
       d AS (SELECT key, date_trunc('day', ts) AS ts, AVG(value) AS mean, MIN(value) AS min, MAX(value) AS max, SUM(value) AS sum, COUNT(value) AS count
             FROM s GROUP BY 1, 2),
       b AS (SELECT key, MIN(ts) AS lo, MAX(ts) AS hi FROM d GROUP BY key),
       g AS (SELECT key, UNNEST(generate_series(lo, hi, INTERVAL 1 DAY)) AS ts FROM b)
       SELECT g.key, CAST(g.ts AS TIMESTAMP) AS ts, ROUND(mean, 6) AS mean, ROUND(min, 6) AS min, ROUND(max, 6) AS max,
              ROUND(COALESCE(sum, 0.0), 6) AS sum, CAST(COALESCE(count, 0) AS BIGINT) AS count
       FROM g LEFT JOIN d ON d.key = g.key AND d.ts = g.ts""",
)
def _(spark, sf):
    return s.resample(frame(spark, sf, IRREGULAR), "day", K)


# A part of the rows lies two months on, so that days between them have none.
HOLES = f"SELECT key, event_id, CASE WHEN event_id % 5 = 0 THEN ts + INTERVAL '61' DAY ELSE ts END AS ts, value FROM ({IRREGULAR}) i WHERE EXTRACT(day FROM ts) % 7 <> 2 OR event_id % 5 = 0"


@check(
    "resample_daily_with_holes",
    """WITH s AS (""" + HOLES + """),
       d AS (SELECT key, date_trunc('day', ts) AS ts, AVG(value) AS mean, MIN(value) AS min, MAX(value) AS max, SUM(value) AS sum, COUNT(value) AS count
             FROM s GROUP BY 1, 2),
       b AS (SELECT key, MIN(ts) AS lo, MAX(ts) AS hi FROM d GROUP BY key),
       g AS (SELECT key, UNNEST(generate_series(lo, hi, INTERVAL 1 DAY)) AS ts FROM b)
       SELECT g.key, CAST(g.ts AS TIMESTAMP) AS ts, ROUND(mean, 6) AS mean, ROUND(min, 6) AS min, ROUND(max, 6) AS max,
              ROUND(COALESCE(sum, 0.0), 6) AS sum, CAST(COALESCE(count, 0) AS BIGINT) AS count
       FROM g LEFT JOIN d ON d.key = g.key AND d.ts = g.ts""",
)
def _(spark, sf):
    return s.resample(frame(spark, sf, HOLES), "day", K)


@check(
    "resample_monthly",
    """WITH d AS (SELECT o_orderpriority AS key, date_trunc('month', o_orderdate) AS ts, MIN(o_totalprice) AS min, MAX(o_totalprice) AS max,
              SUM(o_totalprice) AS sum, COUNT(*) AS count FROM {orders} GROUP BY 1, 2),
       b AS (SELECT key, MIN(ts) AS lo, MAX(ts) AS hi FROM d GROUP BY key),
       g AS (SELECT key, UNNEST(generate_series(lo, hi, INTERVAL 1 MONTH)) AS ts FROM b)
       SELECT g.key, CAST(g.ts AS TIMESTAMP) AS ts, ROUND(min, 2) AS min, ROUND(max, 2) AS max,
              ROUND(COALESCE(sum, 0.0), 2) AS sum, CAST(COALESCE(count, 0) AS BIGINT) AS count
       FROM g LEFT JOIN d ON d.key = g.key AND d.ts = g.ts""",
    digits=2,
)
def _(spark, sf):
    return s.resample(table(spark, sf, "orders").selectExpr("o_orderpriority AS key", "o_orderdate AS ts", "o_totalprice AS value"), "month", K).drop("mean")


LINE = "SELECT CAST(date_trunc('day', l_shipdate) AS TIMESTAMP) AS ts, ROUND(SUM(l_extendedprice), 2) AS value FROM {lineitem} GROUP BY 1"
TRAFO = """SELECT CAST(date_trunc('day', o_orderdate) AS TIMESTAMP) AS ts,
     CASE WHEN EXTRACT(day FROM o_orderdate) = 3 THEN NULL ELSE ROUND(SUM(o_totalprice), 2) END AS value FROM {orders} GROUP BY 1, EXTRACT(day FROM o_orderdate)"""


@check(
    "align_series",
    f"""WITH l AS ({LINE}), t AS ({TRAFO})
        SELECT l.ts, ROUND(l.value, 2) AS line, ROUND(t.value, 2) AS transformer FROM l JOIN t ON l.ts = t.ts
        WHERE l.value IS NOT NULL AND t.value IS NOT NULL""",
    digits=2,
)
def _(spark, sf):
    return s.align(frame(spark, sf, LINE), frame(spark, sf, TRAFO), names=("line", "transformer"))


@check(
    "flow_balance",
    f"""WITH l AS ({LINE}), t AS ({TRAFO}),
        a AS (SELECT l.value AS lv, t.value AS tv, ABS(l.value - t.value) AS d, ABS(l.value - t.value) / NULLIF(ABS(t.value), 0) AS r
              FROM l JOIN t ON l.ts = t.ts WHERE t.value IS NOT NULL)
        SELECT COUNT(*) AS points_compared, ROUND(SUM(lv), 2) AS line_total, ROUND(SUM(tv), 2) AS transformer_total,
               ROUND(AVG(d), 2) AS mean_abs_difference, ROUND(AVG(r), 2) AS mean_relative_difference,
               ROUND(AVG(CASE WHEN r <= 0.2 THEN 1.0 ELSE 0.0 END), 2) AS within_tolerance_ratio, 0.2::DOUBLE AS tolerance FROM a""",
    digits=2,
)
def _(spark, sf):
    return q.summarize_flow_balance(frame(spark, sf, LINE), frame(spark, sf, TRAFO), 0.2)


# Every fifth hour or so has no reading: the last one before it is carried on.
WX = """SELECT ts, CASE WHEN EXTRACT(hour FROM ts) % 5 = 3 THEN NULL ELSE temperature END AS temperature
   FROM (SELECT date_trunc('hour', ts) AS ts, ROUND(AVG(value), 4) AS temperature FROM {events} GROUP BY 1) h"""


@check(
    "feature_left_join",
    f"""WITH l AS (SELECT event_type AS key, event_id, ts, value FROM {{events}}), w AS ({WX}),
        j AS (SELECT l.*, w.temperature AS t FROM l LEFT JOIN w ON w.ts = date_trunc('hour', l.ts))
        SELECT key, event_id, ts, ROUND(value, 6) AS value,
               ROUND(LAST_VALUE(t IGNORE NULLS) OVER ({P} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS temperature
        FROM j""",
)
def _(spark, sf):
    load = frame(spark, sf, "SELECT event_type AS key, event_id, ts, value, date_trunc('hour', ts) AS hour FROM {events}")
    weather = frame(spark, sf, WX).withColumnRenamed("ts", "hour")
    return s.join_features(load, weather, K, "ts", ["hour"], TB).drop("hour")


@check(
    "total_by_time",
    f"""WITH s AS ({IRREGULAR}) SELECT date_trunc('hour', ts) AS ts, ROUND(COALESCE(SUM(value), 0.0), 6) AS plain,
        ROUND(SUM(value), 6) AS needs_one FROM s GROUP BY 1""",
)
def _(spark, sf):
    rows = frame(spark, sf, IRREGULAR).withColumn("ts", F.date_trunc("hour", "ts"))
    plain_total = s.total_by_time(rows).withColumnRenamed("value", "plain")
    return plain_total.join(s.total_by_time(rows, min_count=1).withColumnRenamed("value", "needs_one"), "ts")


# --- steps, gaps, filling ---------------------------------------------------------------------


def _step_sql(binding: str, order: str, w: int, threshold: float, confidence: float, digits: int = 4) -> str:
    part = f"PARTITION BY key ORDER BY {order}"
    return f"""WITH RECURSIVE s AS (SELECT * FROM ({binding}) x WHERE value IS NOT NULL),
      p AS (SELECT *, ROW_NUMBER() OVER ({part}) - 1 AS pos, COUNT(*) OVER (PARTITION BY key) AS n FROM s),
      w AS (SELECT key, ts, pos, n,
              AVG(value) OVER (PARTITION BY key ORDER BY pos ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING) AS mb,
              AVG(value) OVER (PARTITION BY key ORDER BY pos ROWS BETWEEN CURRENT ROW AND {w - 1} FOLLOWING) AS ma,
              STDDEV_SAMP(value) OVER (PARTITION BY key ORDER BY pos ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING) AS sb FROM p),
      c AS (SELECT *, ma - mb AS mag, ABS((ma - mb) / mb) AS rel,
              CASE WHEN sb > 0 THEN LEAST(1.0, ABS(ma - mb) / sb / 3.0) WHEN ABS(ma - mb) > 0 THEN 1.0 ELSE 0.0 END AS conf
            FROM w WHERE pos >= {w} AND pos < n - {w} AND ABS(mb) >= 1e-10),
      f AS (SELECT * FROM c WHERE rel >= {threshold} AND conf >= {confidence}),
      chain AS (SELECT key, MIN(ts) AS anchor FROM f GROUP BY key
                UNION ALL
                SELECT chain.key, MIN(f.ts) AS anchor FROM chain JOIN f ON f.key = chain.key AND f.ts >= chain.anchor + INTERVAL {w} HOUR GROUP BY chain.key),
      a AS (SELECT f.*, (SELECT MAX(anchor) FROM chain WHERE chain.key = f.key AND chain.anchor <= f.ts) AS anchor FROM f),
      r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY key, anchor ORDER BY conf DESC, pos) AS rn FROM a)
      SELECT key, CAST(ts AS TIMESTAMP) AS ts, ROUND(mb, {digits}) AS value_before, ROUND(ma, {digits}) AS value_after, ROUND(mag, {digits}) AS magnitude,
             ROUND(rel, {digits}) AS relative_change, CASE WHEN mag > 0 THEN 'increase' ELSE 'decrease' END AS direction, ROUND(conf, {digits}) AS confidence
      FROM r WHERE rn = 1"""


@check("step_changes", _step_sql(IRREGULAR, "ts, event_id", 24, 0.3, 0.1, 6))
def _(spark, sf):
    return q.detect_step_changes(frame(spark, sf, IRREGULAR), K, threshold=0.3, min_confidence=0.1, tiebreak=TB)


@check("step_changes_daily", _step_sql(DAILY, "ts", 28, 0.2, 0.05), digits=4)
def _(spark, sf):
    return q.detect_step_changes(frame(spark, sf, DAILY), K, threshold=0.2, window_size=28, min_confidence=0.05)


@check(
    "identify_gaps",
    f"""WITH s AS (SELECT * FROM ({HALF_HOURLY}) x WHERE value IS NOT NULL),
        l AS (SELECT key, ts, LAG(ts) OVER (PARTITION BY key ORDER BY ts) AS prev FROM s),
        d AS (SELECT *, epoch_us(ts) - epoch_us(prev) AS us FROM l WHERE prev IS NOT NULL)
        SELECT key, CAST(prev AS TIMESTAMP) AS start, CAST(ts AS TIMESTAMP) AS "end", ROUND(us / 3600000000.0, 6) AS duration_hours,
               CAST(GREATEST(0, us // 1800000000 - 1) AS BIGINT) AS missing_points FROM d WHERE us > 3600000000""",
)
def _(spark, sf):
    return q.identify_gaps(frame(spark, sf, HALF_HOURLY), K)


@check(
    "identify_gaps_irregular",
    f"""WITH s AS (SELECT * FROM ({IRREGULAR}) x WHERE value IS NOT NULL),
        l AS (SELECT key, ts, LAG(ts) OVER (PARTITION BY key ORDER BY ts) AS prev FROM s),
        d AS (SELECT *, epoch_us(ts) - epoch_us(prev) AS us FROM l WHERE prev IS NOT NULL)
        SELECT key, prev AS start, ts AS "end", ROUND(us / 3600000000.0, 6) AS duration_hours,
               CAST(GREATEST(0, us // 600000000 - 1) AS BIGINT) AS missing_points FROM d WHERE us > 900000000""",
)
def _(spark, sf):
    return q.identify_gaps(frame(spark, sf, IRREGULAR), K, expected_frequency="10min", min_gap_hours=0.25)


def _fill_sql(binding: str, expression: str, limit_us: int | None = None, extra: str = "") -> str:
    ok = f"COALESCE(epoch_us(nt) - epoch_us(pt) > {limit_us}, false)" if limit_us else "false"
    return f"""WITH s AS (SELECT * FROM ({binding}) x), f AS (SELECT *,
          LAST_VALUE(CASE WHEN value IS NOT NULL THEN ts END IGNORE NULLS) OVER b AS pt, LAST_VALUE(value IGNORE NULLS) OVER b AS pv,
          FIRST_VALUE(CASE WHEN value IS NOT NULL THEN ts END IGNORE NULLS) OVER a AS nt, FIRST_VALUE(value IGNORE NULLS) OVER a AS nv,
          AVG(value) OVER (PARTITION BY key) AS mean_, MEDIAN(value) OVER (PARTITION BY key) AS median_
        FROM s WINDOW b AS ({P} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), a AS ({P} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)){extra}
        SELECT key, event_id, ts, ROUND(COALESCE(value, CASE WHEN {ok} THEN NULL ELSE {expression} END), 6) AS value FROM f"""


LINEAR = """CASE WHEN nt IS NULL THEN pv WHEN pt IS NOT NULL THEN
   pv + (nv - pv) * (CAST(epoch_us(ts) - epoch_us(pt) AS DOUBLE) / NULLIF(epoch_us(nt) - epoch_us(pt), 0)) END"""
_FILLS = {"linear": LINEAR, "forward": "pv", "backward": "nv", "mean": "mean_", "median": "median_"}

for _method, _expr in _FILLS.items():

    @check(f"fill_gaps_{_method}", _fill_sql(IRREGULAR, _expr))
    def _(spark, sf, method=_method):
        return q.fill_gaps(frame(spark, sf, IRREGULAR), method, K, tiebreak=TB)


@check("fill_gaps_bounded", _fill_sql(IRREGULAR, LINEAR, limit_us=1_800_000_000))
def _(spark, sf):
    return q.fill_gaps(frame(spark, sf, IRREGULAR), "linear", K, max_gap_hours=0.5, tiebreak=TB)


@check(
    "upsample",
    """WITH h AS (SELECT event_type AS key, date_trunc('hour', ts) AS ts, ROUND(SUM(value), 2) AS value FROM {events} GROUP BY 1, 2),
       b AS (SELECT key, MIN(ts) AS lo, MAX(ts) AS hi FROM h GROUP BY key),
       g AS (SELECT key, UNNEST(generate_series(lo, hi, INTERVAL 30 MINUTE)) AS ts FROM b),
       s AS (SELECT g.key, g.ts, h.value FROM g LEFT JOIN h ON h.key = g.key AND h.ts = g.ts),
       f AS (SELECT *, LAST_VALUE(CASE WHEN value IS NOT NULL THEN ts END IGNORE NULLS) OVER b AS pt, LAST_VALUE(value IGNORE NULLS) OVER b AS pv,
                FIRST_VALUE(CASE WHEN value IS NOT NULL THEN ts END IGNORE NULLS) OVER a AS nt, FIRST_VALUE(value IGNORE NULLS) OVER a AS nv
             FROM s WINDOW b AS (PARTITION BY key ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                           a AS (PARTITION BY key ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
       SELECT key, CAST(ts AS TIMESTAMP) AS ts, ROUND(COALESCE(value, """ + LINEAR + """), 10) AS value FROM f""",
    digits=10,
)
def _(spark, sf):
    hourly = frame(spark, sf, "SELECT event_type AS key, date_trunc('hour', ts) AS ts, ROUND(SUM(value), 2) AS value FROM {events} GROUP BY 1, 2")
    return q.upsample(hourly, K)


# --- outliers and low values ------------------------------------------------------------------

OUTLIER_SQL = {
    "zscore": """m AS (SELECT key, AVG(value) AS a, STDDEV_SAMP(value) AS b FROM s GROUP BY key)
        SELECT s.key, event_id, ts, ROUND(value, 6) AS value, COALESCE(ABS(value - a) / NULLIF(b, 0) > 3.0, false) AS is_outlier FROM s JOIN m ON s.key = m.key""",
    "iqr": """m AS (SELECT key, quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b FROM s GROUP BY key)
        SELECT s.key, event_id, ts, ROUND(value, 6) AS value, value < a - 3.0 * (b - a) OR value > b + 3.0 * (b - a) AS is_outlier FROM s JOIN m ON s.key = m.key""",
    "mad": """m AS (SELECT key, median(value) AS a FROM s GROUP BY key),
        d AS (SELECT s.key, median(ABS(value - a)) AS b FROM s JOIN m ON s.key = m.key GROUP BY s.key)
        SELECT s.key, event_id, ts, ROUND(value, 6) AS value, COALESCE(0.6745 * ABS(value - a) / NULLIF(b, 0) > 3.0, false) AS is_outlier
        FROM s JOIN m ON s.key = m.key JOIN d ON s.key = d.key""",
}
for _method, _sql in OUTLIER_SQL.items():

    @check(f"flag_outliers_{_method}", f"WITH s AS (SELECT * FROM ({SPIKY}) x WHERE value IS NOT NULL), {_sql}")
    def _(spark, sf, method=_method):
        return q.flag_outliers(frame(spark, sf, SPIKY), K, method=method)


@check(
    "drop_outliers",
    f"""WITH s AS ({SPIKY}), m AS (SELECT key, quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b FROM s GROUP BY key)
        SELECT s.key, event_id, ts, ROUND(value, 6) AS value FROM s JOIN m ON s.key = m.key
        WHERE NOT (value < a - 2.5 * (b - a) OR value > b + 2.5 * (b - a))""",
)
def _(spark, sf):
    return q.drop_outliers(frame(spark, sf, SPIKY), K, threshold=2.5)


@check(
    "screen_low",
    f"""WITH s AS ({SPIKY}), m AS (SELECT key, GREATEST(0.5, 0.05 * median(value)) AS t FROM s GROUP BY key)
        SELECT s.key, event_id, ts, ROUND(CASE WHEN value = 0 OR (value > 0 AND value < t) THEN NULL ELSE value END, 6) AS value,
               value = 0 OR (value > 0 AND value < t) AS screened FROM s JOIN m ON s.key = m.key""",
)
def _(spark, sf):
    return q.screen_low(frame(spark, sf, SPIKY), K)


SCREENED = f"""SELECT s.key, event_id, ts, CASE WHEN value = 0 OR (value > 0 AND value < t) THEN NULL ELSE value END AS value
   FROM ({SPIKY}) s JOIN (SELECT key, GREATEST(0.5, 0.05 * median(value)) AS t FROM ({SPIKY}) y GROUP BY key) m ON s.key = m.key"""


@check("screen_and_refill", _fill_sql(SCREENED, LINEAR, limit_us=6 * 3_600_000_000))
def _(spark, sf):
    screened = q.screen_low(frame(spark, sf, SPIKY), K).drop("screened")
    return q.fill_gaps(screened, "linear", K, max_gap_hours=6.0, tiebreak=TB)


# --- redaction --------------------------------------------------------------------------------

REDACTED = """SELECT event_id, event_type, ts, CASE WHEN event_id % 17 = 0 THEN ' Redacted ' WHEN event_id % 19 = 0 THEN NULL ELSE 'x' END AS reading,
       CASE WHEN event_id % 23 = 0 THEN NULL WHEN event_id % 29 = 0 THEN -1.0 ELSE value END AS loading FROM {events}"""


@check("detect_redaction", f"SELECT event_id, COALESCE(lower(trim(reading)) IN ('redacted'), false) OR reading IS NULL AS is_redacted FROM ({REDACTED}) x")
def _(spark, sf):
    return q.detect_redaction(frame(spark, sf, REDACTED), "reading").select("event_id", "is_redacted")


@check("detect_redaction_literal", f"SELECT event_id, COALESCE(loading = -1, false) AS is_redacted FROM ({REDACTED}) x")
def _(spark, sf):
    return q.detect_redaction(frame(spark, sf, REDACTED), "loading", markers=[-1], include_missing=False).select("event_id", "is_redacted")


@check(
    "redaction_by_period",
    f"""WITH r AS (SELECT *, COALESCE(lower(trim(reading)) = 'redacted', false) OR reading IS NULL OR loading IS NULL AS hit FROM ({REDACTED}) x)
        SELECT date_trunc('week', ts)::TIMESTAMP AS period, COUNT(*) AS total_points, CAST(SUM(hit::INT) AS BIGINT) AS redacted_points,
               ROUND(AVG(hit::INT), 6) AS redaction_rate FROM r GROUP BY 1""",
)
def _(spark, sf):
    return q.summarize_redaction_by_period(frame(spark, sf, REDACTED), "ts", ["reading", "loading"], "W")


REDACTED_ORDERS = """SELECT o_orderkey, o_orderdate AS timestamp,
       CASE WHEN (o_orderkey * 7 + EXTRACT(month FROM o_orderdate)) % 11 = 0 THEN NULL ELSE o_totalprice END AS value FROM {orders}"""


@check(
    "least_redacted_month_rows",
    f"""WITH r AS ({REDACTED_ORDERS}),
        m AS (SELECT date_trunc('month', timestamp) AS period, AVG(CASE WHEN value IS NULL THEN 1.0 ELSE 0.0 END) AS rate FROM r GROUP BY 1),
        b AS (SELECT period FROM m ORDER BY rate, period LIMIT 1)
        SELECT o_orderkey, timestamp, ROUND(value, 6) AS value FROM r
        WHERE timestamp >= (SELECT period FROM b) AND timestamp <= (SELECT last_day(period)::TIMESTAMP FROM b)""",
)
def _(spark, sf):
    rows = frame(spark, sf, REDACTED_ORDERS)
    monthly = q.summarize_redaction_by_period(rows, "timestamp", ["value"], "M")
    return q.within_period(rows, q.least_redacted_period([monthly]))


@check(
    "least_redacted_period",
    f"""WITH r AS ({REDACTED_ORDERS}),
        m AS (SELECT date_trunc('month', timestamp)::TIMESTAMP AS period, COUNT(*) AS total_points, COUNT(*) - COUNT(value) AS redacted_points FROM r GROUP BY 1)
        SELECT period, CAST(2 * total_points AS BIGINT) AS total_points, CAST(2 * redacted_points AS BIGINT) AS redacted_points,
               ROUND(redacted_points / total_points, 6) AS redaction_rate FROM m ORDER BY redacted_points / total_points, period LIMIT 1""",
)
def _(spark, sf):
    monthly = q.summarize_redaction_by_period(frame(spark, sf, REDACTED_ORDERS), "timestamp", ["value"], "M")
    return q.least_redacted_period([monthly, monthly])


# --- rolling anomalies and report -------------------------------------------------------------

ROLL = f"OVER ({P} ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)"


@check(
    "rolling_anomalies",
    f"""WITH s AS (SELECT key, event_id, ts, CASE WHEN event_id % 13 = 0 THEN NULL ELSE value END AS value FROM ({SPIKY}) x),
        a AS (SELECT *, CASE WHEN COUNT(value) {ROLL} >= 12 THEN MEDIAN(value) {ROLL} END AS base,
                        CASE WHEN COUNT(value) {ROLL} >= 12 THEN STDDEV_SAMP(value) {ROLL} END AS sd FROM s),
        d AS (SELECT *, ABS(value - base) AS dev FROM a),
        m AS (SELECT *, CASE WHEN COUNT(dev) {ROLL} >= 12 THEN MEDIAN(dev) {ROLL} END AS mad FROM d)
        SELECT key, event_id, ts, ROUND(value, 6) AS value,
               COALESCE(0.6745 * dev / NULLIF(mad, 0) > 6.0, false)
               OR ((mad IS NULL OR mad = 0) AND COALESCE(dev / NULLIF(sd, 0) > 3.0, false)) AS is_anomaly FROM m""",
)
def _(spark, sf):
    rows = frame(spark, sf, SPIKY).withColumn("value", F.when(F.col("event_id") % 13 != 0, F.col("value")))
    return q.detect_rolling_anomalies(rows, K, tiebreak=TB)


REPORT_SQL = """
   t AS (SELECT key, COUNT(*) AS total_points, COUNT(value) AS valid_points, COUNT(*) - COUNT(value) AS missing_points FROM s GROUP BY key),
   m AS (SELECT key, quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b FROM s GROUP BY key),
   o AS (SELECT s.key, SUM(CASE WHEN value < a - 3 * (b - a) OR value > b + 3 * (b - a) THEN 1 ELSE 0 END) AS outlier_points
         FROM s JOIN m ON s.key = m.key WHERE value IS NOT NULL GROUP BY s.key),
   l AS (SELECT key, epoch_us(ts) - epoch_us(LAG(ts) OVER (PARTITION BY key ORDER BY ts)) AS us FROM s WHERE value IS NOT NULL),
   g AS (SELECT key, COUNT(*) AS gap_count, SUM(us) / 3600000000.0 AS gap_hours FROM l WHERE us > 3600000000 GROUP BY key),
   r AS (SELECT t.*, COALESCE(outlier_points, 0) AS outlier_points, COALESCE(gap_count, 0) AS gap_count, COALESCE(gap_hours, 0.0) AS gap_hours
         FROM t LEFT JOIN o ON o.key = t.key LEFT JOIN g ON g.key = t.key)
   SELECT key, total_points, valid_points, missing_points, CAST(outlier_points AS BIGINT) AS outlier_points, CAST(gap_count AS BIGINT) AS gap_count,
          ROUND(gap_hours, 6) AS gap_hours,
          ROUND(GREATEST(0.0, 100.0 * valid_points / total_points - LEAST(50.0, 100.0 * outlier_points / GREATEST(valid_points, 1)) - LEAST(30, gap_count * 5)), 6) AS quality_score,
          concat_ws('; ',
            CASE WHEN missing_points > 0 THEN printf('Missing data: %d points (%.1f%%)', missing_points, 100.0 * missing_points / total_points) END,
            CASE WHEN outlier_points > 0 THEN printf('Outliers detected: %d points (%.1f%%)', CAST(outlier_points AS BIGINT), 100.0 * outlier_points / GREATEST(valid_points, 1)) END,
            CASE WHEN gap_count > 0 THEN printf('Data gaps: %d gaps totaling %.1f hours', CAST(gap_count AS BIGINT), gap_hours) END) AS issues
   FROM r"""


def quality_report(rows):
    return q.quality_control(rows, K).withColumn("issues", F.concat_ws("; ", "issues"))


@check("quality_report", f"WITH s AS ({IRREGULAR}), {REPORT_SQL}")
def _(spark, sf):
    return quality_report(frame(spark, sf, IRREGULAR))


@check("quality_report_grid", f"WITH s AS (WITH {GRID_SQL} SELECT * FROM grid), {REPORT_SQL}")
def _(spark, sf):
    return quality_report(s.regular_grid(frame(spark, sf, HALF_HOURLY), K))
