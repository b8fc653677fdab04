"""Series statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridspark.operators import stats as st
from gridspark.plans import exact_quantiles
from gridspark.workload.base import HALF_HOURLY, IRREGULAR, ORDERS, check, frame

K = ["key"]
TB = "event_id"
P = "PARTITION BY key ORDER BY ts, event_id"

# A few infinities, which the summary has to leave out and report.
WITH_INF = """SELECT event_type AS key, event_id, ts, CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 501 = 0 THEN CAST('Infinity' AS DOUBLE)
   ELSE value END AS value FROM {events}"""
QUANTILES = ", ".join(f"ROUND(quantile_cont(x, {p / 100}), 6) AS p{p}" for p in (10, 25, 50, 75, 90, 95, 99))


@check(
    "describe_timeseries",
    f"""WITH s AS (SELECT key, ts, CASE WHEN isfinite(value) THEN value END AS x, value FROM ({WITH_INF}) y),
        m AS (SELECT key, AVG(x) AS mean, STDDEV_SAMP(x) AS std FROM s GROUP BY key),
        b AS (SELECT s.key, COUNT(x) AS count, ROUND(AVG(x), 6) AS mean, ROUND(STDDEV_SAMP(x), 6) AS std, ROUND(MIN(x), 6) AS min, ROUND(MAX(x), 6) AS max,
                ROUND(AVG(POWER(x - m.mean, 3)) / POWER(ANY_VALUE(m.std), 3), 6) AS skewness, ROUND(AVG(POWER(x - m.mean, 4)) / POWER(ANY_VALUE(m.std), 4) - 3, 6) AS kurtosis,
                CAST(SUM(CASE WHEN value IS NOT NULL AND x IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS excluded_non_finite_count,
                {QUANTILES}, ROUND(median(x), 6) AS median,
                SUM(CASE WHEN value IS NOT NULL AND x IS NULL THEN 1 ELSE 0 END) > 0 AS has_non_finite_values
              FROM s JOIN m ON s.key = m.key GROUP BY s.key),
        h AS (SELECT key, EXTRACT(hour FROM ts) AS u, AVG(x) AS v FROM s WHERE x IS NOT NULL GROUP BY 1, 2),
        w AS (SELECT key, isodow(ts) - 1 AS u, AVG(x) AS v FROM s WHERE x IS NOT NULL GROUP BY 1, 2),
        hc AS (SELECT key, STDDEV_SAMP(v) / AVG(v) AS cv FROM h GROUP BY key),
        wc AS (SELECT key, STDDEV_SAMP(v) / AVG(v) AS cv FROM w GROUP BY key)
        SELECT b.*, ROUND(hc.cv, 6) AS daily_variation_cv, hc.cv > 0.05 AS has_daily_pattern,
               CASE WHEN count >= 336 THEN ROUND(wc.cv, 6) END AS weekly_variation_cv, CASE WHEN count >= 336 THEN wc.cv > 0.03 END AS has_weekly_pattern
        FROM b LEFT JOIN hc ON hc.key = b.key LEFT JOIN wc ON wc.key = b.key""",
)
def _(spark, sf):
    return st.describe_timeseries(frame(spark, sf, WITH_INF), K)


@check(
    "seasonal_hints",
    f"""WITH s AS (SELECT * FROM ({ORDERS}) x),
        w AS (SELECT key, isodow(ts) - 1 AS u, AVG(value) AS v, COUNT(*) AS k FROM s GROUP BY 1, 2),
        h AS (SELECT key, EXTRACT(hour FROM ts) AS u, AVG(value) AS v, COUNT(*) AS k FROM s GROUP BY 1, 2),
        hc AS (SELECT key, CASE WHEN SUM(k) >= 48 AND COUNT(*) >= 12 THEN STDDEV_SAMP(v) / AVG(v) END AS cv FROM h GROUP BY key),
        wc AS (SELECT key, CASE WHEN SUM(k) >= 336 AND COUNT(*) >= 5 THEN STDDEV_SAMP(v) / AVG(v) END AS cv FROM w GROUP BY key)
        SELECT hc.key, ROUND(hc.cv, 6) AS daily_variation_cv, hc.cv > 0.05 AS has_daily_pattern, ROUND(wc.cv, 6) AS weekly_variation_cv, wc.cv > 0.03 AS has_weekly_pattern
        FROM hc JOIN wc ON wc.key = hc.key""",
)
def _(spark, sf):
    return st.seasonal_hints(frame(spark, sf, ORDERS), K)


@check(
    "autocorrelation",
    f"""WITH s AS (SELECT * FROM ({IRREGULAR}) x WHERE value IS NOT NULL),
        p AS (SELECT key, ROW_NUMBER() OVER ({P}) AS pos, value - AVG(value) OVER (PARTITION BY key) AS d FROM s),
        v AS (SELECT key, VAR_SAMP(d) AS var, COUNT(*) AS n FROM p GROUP BY key),
        lags AS (SELECT UNNEST(range(0, 49)) AS lag),
        r AS (SELECT a.key, lags.lag, SUM(a.d * b.d) AS sp FROM p a CROSS JOIN lags JOIN p b ON b.key = a.key AND b.pos = a.pos - lags.lag GROUP BY 1, 2)
        SELECT r.key, r.lag, ROUND(CASE WHEN r.lag = 0 THEN 1.0 ELSE sp / n / var END, 6) AS autocorrelation FROM r JOIN v ON v.key = r.key""",
)
def _(spark, sf):
    return st.autocorrelation(frame(spark, sf, IRREGULAR), K, tiebreak=TB)


SEASON = {
    "daily": (IRREGULAR, "EXTRACT(hour FROM ts)"),
    "weekly": (ORDERS, "isodow(ts) - 1"),
    "annual": (ORDERS, "EXTRACT(month FROM ts)"),
}
for _period, (_binding, _unit) in SEASON.items():
    _profile = f"""SELECT key, CAST({_unit} AS BIGINT) AS unit, ROUND(AVG(value), 5) AS mean, ROUND(STDDEV_SAMP(value), 5) AS std,
       ROUND(MIN(value), 5) AS min, ROUND(MAX(value), 5) AS max FROM ({_binding}) x WHERE value IS NOT NULL GROUP BY 1, 2"""

    @check(f"seasonal_pattern_{_period}", _profile, digits=5)
    def _(spark, sf, period=_period, binding=_binding):
        return st.seasonal_pattern(frame(spark, sf, binding), period, K)

    @check(
        f"seasonal_summary_{_period}",
        f"""WITH p AS (SELECT key, CAST({_unit} AS BIGINT) AS unit, AVG(value) AS mean FROM ({_binding}) x WHERE value IS NOT NULL GROUP BY 1, 2),
            r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY key ORDER BY mean DESC, unit) AS rn, MAX(mean) OVER (PARTITION BY key) / MIN(mean) OVER (PARTITION BY key) AS ratio FROM p)
            SELECT key, unit AS dominant_unit, ROUND(ratio, 6) AS range_ratio, '{_period}' AS period FROM r WHERE rn = 1""",
    )
    def _(spark, sf, period=_period, binding=_binding):
        return st.seasonal_summary(frame(spark, sf, binding), period, K)


@check(
    "quantile_bands",
    f"""SELECT key, CAST(EXTRACT(hour FROM ts) AS BIGINT) AS hour, ROUND(quantile_cont(value, 0.25), 6) AS q25, ROUND(quantile_cont(value, 0.75), 6) AS q75,
        ROUND(AVG(value), 6) AS mean FROM ({IRREGULAR}) x GROUP BY 1, 2""",
)
def _(spark, sf):
    return st.quantile_bands(frame(spark, sf, IRREGULAR), K)


RUN_SQL = f"""
    p AS (SELECT s.*, t.t, ROW_NUMBER() OVER (PARTITION BY s.key ORDER BY ts, event_id) AS pos FROM s JOIN t ON s.key = t.key),
    a AS (SELECT *, pos - ROW_NUMBER() OVER (PARTITION BY key ORDER BY pos) AS run FROM p WHERE value > t),
    r AS (SELECT key, MAX(c) AS longest FROM (SELECT key, run, COUNT(*) AS c FROM a GROUP BY 1, 2) y GROUP BY key)"""


def _top(kind: str, unit: str) -> str:
    return f"""{kind} AS (SELECT key, string_agg(CAST(u AS VARCHAR), ',' ORDER BY rn) AS {kind} FROM (
        SELECT key, u, ROW_NUMBER() OVER (PARTITION BY key ORDER BY c DESC, u) AS rn FROM (
          SELECT key, {unit} AS u, COUNT(*) AS c FROM a GROUP BY 1, 2) x) y WHERE rn <= 3 GROUP BY key)"""


@check(
    "peak_analysis",
    f"""WITH s AS (SELECT * FROM ({IRREGULAR}) x WHERE value IS NOT NULL),
        t AS (SELECT key, quantile_cont(value, 0.9) AS t FROM s GROUP BY key), {RUN_SQL},
        {_top("peak_hours", "EXTRACT(hour FROM ts)")}, {_top("peak_days", "isodow(ts) - 1")}, {_top("peak_months", "EXTRACT(month FROM ts)")},
        b AS (SELECT key, MAX(value) AS hi, MIN(value) AS lo, AVG(value) AS mean, COUNT(*) AS n FROM s GROUP BY key),
        hi AS (SELECT s.key, MIN(ts) AS ts FROM s JOIN b ON b.key = s.key AND s.value = b.hi GROUP BY s.key),
        lo AS (SELECT s.key, MIN(ts) AS ts FROM s JOIN b ON b.key = s.key AND s.value = b.lo GROUP BY s.key),
        n AS (SELECT key, COUNT(*) AS above FROM a GROUP BY key)
        SELECT b.key, ROUND(b.hi, 6) AS peak_value, hi.ts AS peak_timestamp, ROUND(b.lo, 6) AS trough_value, lo.ts AS trough_timestamp,
               CASE WHEN b.lo <> 0 THEN ROUND(b.hi / b.lo, 6) WHEN b.hi <> 0 THEN CAST('Infinity' AS DOUBLE) ELSE 1.0 END AS peak_to_trough_ratio, ROUND(b.mean / b.hi, 6) AS mean_to_peak_ratio, CAST(90.0 AS DOUBLE) AS threshold_percentile,
               ROUND(t.t, 6) AS threshold_value, ROUND(100.0 * above / b.n, 6) AS time_above_threshold_pct,
               peak_hours, peak_days, peak_months, r.longest AS max_consecutive_above_threshold
        FROM b JOIN hi ON hi.key = b.key JOIN lo ON lo.key = b.key JOIN t ON t.key = b.key JOIN n ON n.key = b.key JOIN r ON r.key = b.key
        JOIN peak_hours ON peak_hours.key = b.key JOIN peak_days ON peak_days.key = b.key JOIN peak_months ON peak_months.key = b.key""",
)
def _(spark, sf):
    out = st.peak_analysis(frame(spark, sf, IRREGULAR), 90.0, K, tiebreak=TB)
    return out.withColumns({c: F.concat_ws(",", F.col(c).cast("array<string>")) for c in ("peak_hours", "peak_days", "peak_months")})


@check(
    "longest_run_above",
    f"""WITH s AS (SELECT * FROM ({IRREGULAR}) x WHERE value IS NOT NULL), t AS (SELECT key, quantile_cont(value, 0.25) AS t FROM s GROUP BY key), {RUN_SQL}
        SELECT key, longest AS longest_run FROM r""",
)
def _(spark, sf):
    rows = frame(spark, sf, IRREGULAR)
    return st.longest_run(rows, exact_quantiles(rows, K, "value", {"t": 0.25}), "t", K, tiebreak=TB)


@check(
    "seasonal_pattern_half_hourly",
    f"""SELECT key, CAST(isodow(ts) - 1 AS BIGINT) AS unit, ROUND(AVG(value), 6) AS mean, ROUND(STDDEV_SAMP(value), 6) AS std, ROUND(MIN(value), 6) AS min,
        ROUND(MAX(value), 6) AS max FROM ({HALF_HOURLY}) x GROUP BY 1, 2""",
)
def _(spark, sf):
    return st.seasonal_pattern(frame(spark, sf, HALF_HOURLY), "weekly", K)
