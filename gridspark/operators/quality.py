"""Series quality control: steps, gaps, filling, outliers, redaction, rolling anomalies, balance."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridspark.functions.scalars import is_redacted
from gridspark.functions.timeparts import duration_micros, micros, period_unit, truncate
from gridspark.operators.series import align, neighbours, previous_time, regular_grid
from gridspark.plans import CHUNK, attach, exact_quantiles, halo_blocks, is_split, keyed, largest_group, positions, sized, split_hot, unkeyed
from gridspark.plans.skew import BLOCK, HOME, POS, TARGET_ROWS
from gridspark.sources.staging import staged

# Rows of step candidates handled by one call of the grouping helper.
_CANDIDATE_ROWS = 500_000
_HOUR = 3_600_000_000
# Window cells that the rolling medians hold at once.
_WINDOW_CELLS = 2_000_000
_MIN_GAP_HOURS = 1.0


# --- step changes -----------------------------------------------------------------------------


def step_candidates(
    df: DataFrame,
    keys: Sequence[str] = (),
    ts: str = "ts",
    value: str = "value",
    threshold: float = 0.1,
    window_size: int = 24,
    min_confidence: float = 0.7,
    tiebreak: str | None = None,
    target_rows: int | None = None,
    at_most: int | None = None,
) -> DataFrame:
    """Every place where the mean of the next window departs from the mean of the window before."""
    df, keys = keyed(df, keys)
    w = window_size
    pick = list(dict.fromkeys([*keys, ts, value, *([tiebreak] if tiebreak else [])]))
    rows = positions(df.where(F.col(value).isNotNull()).select(*pick), keys, ts, tiebreak, target_rows=target_rows, at_most=at_most)
    rows, order = halo_blocks(rows, keys, w, w - 1, target_rows)
    before, after = order.rowsBetween(-w, -1), order.rowsBetween(0, w - 1)
    rows = rows.select(
        *pick,
        POS,
        "_n",
        HOME,
        F.avg(value).over(before).alias("value_before"),
        F.avg(value).over(after).alias("value_after"),
        F.stddev_samp(value).over(before).alias("_std"),
    )
    size = F.abs(F.col("magnitude"))
    confidence = (
        F.when(F.col("_std") > 0, F.least(F.lit(1.0), size / F.col("_std") / 3.0)).when(size > 0, 1.0).otherwise(0.0)
    )
    return (
        rows.where(F.col(HOME) & (F.col(POS) >= w) & (F.col(POS) < F.col("_n") - w))
        .where(F.abs("value_before") >= 1e-10)
        .withColumn("magnitude", F.col("value_after") - F.col("value_before"))
        .withColumn("relative_change", F.abs(F.col("magnitude") / F.nullif(F.col("value_before"), F.lit(0.0))))
        .where(F.col("relative_change") >= threshold)
        .withColumn("direction", F.when(F.col("magnitude") > 0, "increase").otherwise("decrease"))
        .withColumn("confidence", confidence)
        .where(F.col("confidence") >= min_confidence)
        .drop(HOME, "_n", "_std", value)
    )


def detect_step_changes(
    df: DataFrame,
    keys: Sequence[str] = (),
    ts: str = "ts",
    value: str = "value",
    threshold: float = 0.1,
    window_size: int = 24,
    min_confidence: float = 0.7,
    tiebreak: str | None = None,
    target_rows: int | None = None,
) -> DataFrame:
    """Step changes, one per group of nearby candidates.

    A group starts at its first member and takes candidates less than ``window_size`` hours after it;
    the most confident one (the earliest on ties) is reported.
    """
    out_keys = list(keys)
    df, keys = keyed(df, keys)
    # A series has no more candidates than rows.
    df, at_most = sized(df, keys)
    found = step_candidates(df, keys, ts, value, threshold, window_size, min_confidence, tiebreak, target_rows, at_most)
    found = found.withColumn("_us", micros(ts))
    if at_most > (target_rows or _CANDIDATE_ROWS):
        found = staged(found, "step_candidates")  # cutting a large series looks at them several times
    anchored = _with_anchor(found, keys, window_size * _HOUR, target_rows, at_most)
    fields = [ts, "value_before", "value_after", "magnitude", "relative_change", "direction", "confidence"]
    best = F.max_by(F.struct(*fields), F.struct("confidence", -F.col(POS)))
    return anchored.groupBy(*keys, "_anchor").agg(best.alias("_b")).select(*out_keys, "_b.*")


def _with_anchor(found: DataFrame, keys: list[str], span: int, target_rows: int | None, at_most: int | None) -> DataFrame:
    """Give each candidate the time of its group's first member.

    Groups form a chain: the next one starts at the first candidate ``span`` or more after the last
    start. Within a chunk the chain is followed in memory. Over chunks, each chunk first reports where
    a chain that enters it would leave it, for every place it may enter; following those reports gives
    each chunk its real entry.
    """
    rows = split_hot(found, keys, "_us", POS, target_rows or _CANDIDATE_ROWS, at_most)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema.fields)
    if not is_split(rows):
        rows = rows.withColumn("_entry", F.lit(None).cast("long"))
    else:
        rows = rows.join(_chunk_entries(rows, keys, span), [*keys, CHUNK], "left")

    def mark(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_us", POS], kind="stable")
        entry = pdf["_entry"].iloc[0]
        pdf["_anchor"] = _anchors(pdf["_us"].to_numpy(), None if pd.isna(entry) else int(entry), span)
        return pdf.drop(columns=[CHUNK, "_entry"])

    return rows.groupBy(*keys, CHUNK).applyInPandas(mark, f"{fields}, _anchor long")


def _anchors(t: np.ndarray, entry: int | None, span: int) -> np.ndarray:
    """Anchor of every sorted time; ``entry`` is the anchor still open from before."""
    out = np.empty(len(t), dtype="int64")
    i = 0
    if entry is not None:
        i = int(np.searchsorted(t, entry + span))
        out[:i] = entry
    while i < len(t):
        j = int(np.searchsorted(t, t[i] + span))
        out[i:j] = t[i]
        i = j
    return out


class _Report(NamedTuple):
    """Where chains leave a chunk: entering at the first candidate up to ``upto``, the last start is ``leave``."""

    begin: int
    upto: np.ndarray
    leave: np.ndarray
    final: int

    def passed(self, opened: np.ndarray, span: int) -> np.ndarray:
        """The open starts after this chunk, for starts that were open before it."""
        at = np.minimum(np.searchsorted(self.upto, opened + span), len(self.upto) - 1)
        # Without a candidate late enough to start a group, the open one stays open.
        return np.where(opened + span <= self.final, self.leave[at], opened)


def _reports(pdf: pd.DataFrame, by: str) -> Iterator[tuple[int, _Report]]:
    for number, part in pdf.sort_values([by, "_upto"]).groupby(by, sort=True):
        first = part.iloc[0]
        yield number, _Report(int(first["_begin"]), part["_upto"].to_numpy(), part["_leave"].to_numpy(), int(first["_final"]))


def _chunk_entries(rows: DataFrame, keys: list[str], span: int) -> DataFrame:
    """The start that is open where each chunk begins (null for the first).

    Chunks of a series are followed in sections, and sections in turn, so that one call sees about the
    square root of the number of chunks however long the series is.
    """
    key_fields = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys)
    report_fields = "_begin long, _upto long, _leave long, _final long"

    def exits(pdf: pd.DataFrame) -> pd.DataFrame:
        t = np.unique(pdf["_us"].to_numpy())
        # Each start points to the next one, the last of a chain to itself; doubling finds the ends.
        nxt = np.searchsorted(t, t + span)
        end = np.where(nxt < len(t), nxt, np.arange(len(t)))
        while not np.array_equal(end, end[end]):
            end = end[end]
        leave = t[end]
        # A chain enters no later than at the first candidate a full span into the chunk.
        last = min(len(t) - 1, int(np.searchsorted(t, t[0] + span)))
        keep = np.append(np.flatnonzero(leave[:last] != leave[1 : last + 1]), last)
        head = pdf[[*keys, CHUNK]].iloc[[0] * len(keep)].reset_index(drop=True)
        return head.assign(_begin=t[0], _upto=t[keep], _leave=leave[keep], _final=t[-1])

    reports = (
        rows.select(*keys, CHUNK, "_us")
        .groupBy(*keys, CHUNK)
        .applyInPandas(exits, f"{key_fields}, {CHUNK} long, {report_fields}")
    )
    whole = Window.partitionBy(*keys)
    order = F.row_number().over(whole.orderBy(CHUNK)) - 1
    width = F.ceil(F.sqrt(F.count("*").over(whole)))
    sections = rows.select(*keys, CHUNK).distinct().select(*keys, CHUNK, F.floor(order / width).alias("_section"))
    reports = reports.join(sections, [*keys, CHUNK])

    def section_exits(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = [r for _, r in _reports(pdf, CHUNK)]
        upto, leave = [], []
        for i, part in enumerate(parts):
            # Later chunks can be entered from outside only within a span of the section's begin.
            if i and parts[i - 1].final >= parts[0].begin + span:
                break
            opened = part.leave
            for later in parts[i + 1 :]:
                opened = later.passed(opened, span)
            upto.append(part.upto)
            leave.append(opened)
        upto, leave = np.concatenate(upto), np.concatenate(leave)
        head = pdf[[*keys, "_section"]].iloc[[0] * len(upto)].reset_index(drop=True)
        return head.assign(_begin=parts[0].begin, _upto=upto, _leave=leave, _final=parts[-1].final)

    def follow(by: str):
        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            given = pdf["_opened"].iloc[0]
            opened = None if pd.isna(given) else int(given)
            numbers, entries = [], []
            for number, part in _reports(pdf, by):
                numbers.append(number)
                entries.append(opened)
                opened = int(part.leave[0] if opened is None else part.passed(np.array([opened]), span)[0])
            head = pdf[keys].iloc[[0] * len(numbers)].reset_index(drop=True)
            return head.assign(**{by: numbers, "_entry": pd.array(entries, dtype="Int64")})

        return run

    by_section = reports.groupBy(*keys, "_section").applyInPandas(section_exits, f"{key_fields}, _section long, {report_fields}")
    opened = (
        by_section.withColumn("_opened", F.lit(None).cast("long"))
        .groupBy(*keys)
        .applyInPandas(follow("_section"), f"{key_fields}, _section long, _entry long")
        .withColumnRenamed("_entry", "_opened")
    )
    return (
        reports.join(opened, [*keys, "_section"])
        .groupBy(*keys, "_section")
        .applyInPandas(follow(CHUNK), f"{key_fields}, {CHUNK} long, _entry long")
    )


# --- gaps and filling -------------------------------------------------------------------------


def identify_gaps(
    df: DataFrame,
    keys: Sequence[str] = (),
    ts: str = "ts",
    value: str = "value",
    expected_frequency: str = "30min",
    min_gap_hours: float = _MIN_GAP_HOURS,
    target_rows: int | None = None,
    at_most: int | None = None,
) -> DataFrame:
    """Spans between consecutive filled points that are longer than ``min_gap_hours``."""
    step = duration_micros(expected_frequency)
    asked = keys
    df, keys = keyed(df, keys)
    rows = df.where(F.col(value).isNotNull()).select(*keys, ts)
    if at_most is None:
        at_most = largest_group(rows, keys)
    if at_most > (target_rows or TARGET_ROWS):
        # Repeated times make no gap; without them no instant is crowded.
        rows = rows.distinct()
    rows = previous_time(rows, keys, ts, target_rows=target_rows, at_most=at_most)
    span = micros(ts) - micros("_before")
    return unkeyed(
        rows.withColumn("_span", span)
        .where(F.col("_span") > min_gap_hours * _HOUR)
        .select(
            *keys,
            F.col("_before").alias("start"),
            F.col(ts).alias("end"),
            (F.col("_span") / float(_HOUR)).alias("duration_hours"),
            F.greatest(F.lit(0), F.floor(F.col("_span") / F.lit(step)) - 1).cast("long").alias("missing_points"),
        ),
        asked,
    )


_FILL_METHODS = ("linear", "forward", "backward", "mean", "median")


def fill_gaps(
    df: DataFrame,
    method: str = "linear",
    keys: Sequence[str] = (),
    ts: str = "ts",
    value: str = "value",
    max_gap_hours: float | None = None,
    tiebreak: str | None = None,
    target_rows: int | None = None,
) -> DataFrame:
    """Replace null values.

    ``linear`` weights by time between the filled neighbours, repeats the last value at the end and
    leaves leading nulls. With ``max_gap_hours`` a gap between two filled points that lie further
    apart stays null; gaps at an edge follow the method.
    """
    if method not in _FILL_METHODS:
        raise ValueError(f"fill method {method!r} is none of {_FILL_METHODS}")
    names = df.columns
    df, keys = keyed(df, keys)
    bounded = max_gap_hours is not None
    if method in ("mean", "median"):
        df, at_most = sized(df, keys)
        if method == "mean":
            stats = df.groupBy(*keys).agg(F.avg(value).alias("_fill"))
        else:
            stats = exact_quantiles(df, keys, value, {"_fill": 0.5}, at_most=at_most)
        rows = neighbours(df, keys, ts, value, tiebreak, target_rows, at_most) if bounded else df
        rows = attach(rows, stats, keys, target_rows, at_most)
        fill = F.col("_fill")
    else:
        rows = neighbours(df, keys, ts, value, tiebreak, target_rows)
        prev, nxt = F.col("_prev"), F.col("_next")
        if method == "forward":
            fill = prev["_v"]
        elif method == "backward":
            fill = nxt["_v"]
        else:
            # Neighbours at one and the same time leave nothing to weight: the first of them is taken.
            span = F.nullif(micros(nxt[ts]) - micros(prev[ts]), F.lit(0))
            share = F.coalesce((micros(ts) - micros(prev[ts])) / span, F.lit(0.0))
            between = prev["_v"] + (nxt["_v"] - prev["_v"]) * share
            fill = F.when(nxt.isNull(), prev["_v"]).when(prev.isNotNull(), between)
    if bounded:
        prev, nxt = F.col("_prev"), F.col("_next")
        too_long = micros(nxt[ts]) - micros(prev[ts]) > max_gap_hours * _HOUR
        fill = F.when(~F.coalesce(too_long, F.lit(False)), fill)
    return rows.withColumn(value, F.coalesce(F.col(value), fill)).select(*names)


def upsample(df: DataFrame, keys: Sequence[str] = (), ts: str = "ts", value: str = "value", every: str = "30min", target_rows: int | None = None) -> DataFrame:
    """Show a series on a finer grid, linear between points, last value kept at the end."""
    return fill_gaps(regular_grid(df, keys, ts, value, every, "floor"), "linear", keys, ts, value, target_rows=target_rows)


# --- outliers ---------------------------------------------------------------------------------


def flag_outliers(
    df: DataFrame,
    keys: Sequence[str] = (),
    value: str = "value",
    method: str = "iqr",
    threshold: float = 3.0,
    target_rows: int | None = None,
    at_most: int | None = None,
) -> DataFrame:
    """Keep rows with a value and add ``is_outlier`` (zscore, iqr or mad rule per series)."""
    names = df.columns
    df, keys = keyed(df.where(F.col(value).isNotNull()), keys)
    if at_most is None:
        df, at_most = sized(df, keys)
    stats, flag = _outlier_rule(df, keys, value, method, threshold, target_rows, at_most)
    return attach(df, stats, keys, target_rows, at_most).withColumn("is_outlier", flag).select(*names, "is_outlier")


def _outlier_rule(df: DataFrame, keys: list[str], value: str, method: str, threshold: float, target_rows: int | None, at_most: int) -> tuple[DataFrame, Column]:
    """Statistics per series and the rule that flags a row joined with them."""
    v = F.col(value)
    if method == "zscore":
        stats = df.groupBy(*keys).agg(F.avg(value).alias("_m"), F.stddev_samp(value).alias("_s"))
        flag = F.abs(v - F.col("_m")) / F.nullif(F.col("_s"), F.lit(0.0)) > threshold
    elif method == "iqr":
        stats = exact_quantiles(df, keys, value, {"_a": 0.25, "_b": 0.75}, at_most=at_most)
        reach = threshold * (F.col("_b") - F.col("_a"))
        flag = (v < F.col("_a") - reach) | (v > F.col("_b") + reach)
    elif method == "mad":
        medians = exact_quantiles(df, keys, value, {"_m": 0.5}, at_most=at_most)
        dev = attach(df.select(*keys, value), medians, keys, target_rows, at_most).withColumn("_d", F.abs(v - F.col("_m")))
        stats = exact_quantiles(dev, keys, "_d", {"_mad": 0.5}, [F.first("_m").alias("_m")], at_most=at_most)
        flag = 0.6745 * F.abs(v - F.col("_m")) / F.nullif(F.col("_mad"), F.lit(0.0)) > threshold
    else:
        raise ValueError(f"outlier method {method!r} is none of ('zscore', 'iqr', 'mad')")
    return stats, F.coalesce(flag, F.lit(False))


def drop_outliers(df: DataFrame, keys: Sequence[str] = (), value: str = "value", method: str = "iqr", threshold: float = 3.0, target_rows: int | None = None) -> DataFrame:
    """Rows that :func:`flag_outliers` does not flag."""
    return flag_outliers(df, keys, value, method, threshold, target_rows).where(~F.col("is_outlier")).drop("is_outlier")


def screen_low(df: DataFrame, keys: Sequence[str] = (), value: str = "value", floor: float = 0.5, share: float = 0.05, target_rows: int | None = None) -> DataFrame:
    """Blank zeros and values below max(``floor``, ``share`` of the median); adds ``screened``."""
    names = df.columns
    df, keys = keyed(df, keys)
    df, at_most = sized(df, keys)
    medians = exact_quantiles(df, keys, value, {"_med": 0.5}, at_most=at_most)
    v = F.col(value)
    limit = F.greatest(F.lit(floor), F.col("_med") * share)
    bad = F.coalesce((v == 0) | ((v > 0) & (v < limit)), F.lit(False))
    rows = attach(df, medians, keys, target_rows, at_most).withColumn("screened", bad)
    return rows.withColumn(value, F.when(~F.col("screened"), v)).select(*names, "screened")


# --- redaction --------------------------------------------------------------------------------


def detect_redaction(df: DataFrame, column: str, markers: Sequence[str | int | float] | None = None, include_missing: bool = True) -> DataFrame:
    """Add ``is_redacted`` for one column."""
    return df.withColumn("is_redacted", is_redacted(df, column, markers, include_missing))


def summarize_redaction_by_period(
    df: DataFrame,
    timestamp_field: str = "timestamp",
    value_fields: Sequence[str] | None = None,
    period: str = "M",
    markers: Sequence[str | int | float] | None = None,
    include_missing_fallback: bool = True,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Rows, redacted rows and rate per period; a row counts when any of its value fields is redacted."""
    if timestamp_field not in df.columns:
        raise ValueError(f"no time column {timestamp_field!r}; name one as timestamp_field")
    fields = list(value_fields) if value_fields is not None else [c for c in df.columns if c not in (timestamp_field, *keys)]
    missing = [f for f in fields if f not in df.columns]
    if missing:
        raise ValueError(f"no columns {missing}")
    if not fields:
        raise ValueError("no value column is left to look at")
    flag = F.lit(False)
    for f in fields:
        flag = flag | is_redacted(df, f, markers, include_missing_fallback)
    stamp = F.col(timestamp_field)
    if df.schema[timestamp_field].dataType.typeName() == "string":
        stamp = F.try_to_timestamp(stamp)
        start = F.date_trunc(period_unit(period), stamp)
    else:
        start = truncate(stamp, period_unit(period), df, timestamp_field)
    return (
        df.where(stamp.isNotNull())
        .groupBy(*keys, start.alias("period"))
        .agg(F.count("*").alias("total_points"), F.sum(flag.cast("long")).alias("redacted_points"))
        .withColumn("redaction_rate", F.col("redacted_points") / F.col("total_points"))
        .orderBy(*keys, "period")
    )


def least_redacted_period(summaries: Sequence[DataFrame]) -> DataFrame:
    """The period with the lowest rate over several summaries (the earliest on ties): one row."""
    union = summaries[0]
    for s in summaries[1:]:
        union = union.unionByName(s)
    return (
        union.groupBy("period")
        .agg(F.sum("total_points").alias("total_points"), F.sum("redacted_points").alias("redacted_points"))
        .withColumn("redaction_rate", F.col("redacted_points") / F.col("total_points"))
        .orderBy("redaction_rate", "period")
        .limit(1)
    )


def within_period(df: DataFrame, period: DataFrame, ts: str = "timestamp", end_inclusive_day: bool = False) -> DataFrame:
    """Rows of the month given by a one-row ``period`` frame.

    The end bound is the last day at midnight, so later rows of that day are left out;
    ``end_inclusive_day=True`` keeps them.
    """
    month = period.select(F.col("period")).scalar()
    last = F.last_day(month)
    end = F.date_add(last, 1).cast("timestamp") if end_inclusive_day else last.cast("timestamp")
    t = F.col(ts).cast("timestamp")
    upper = t < end if end_inclusive_day else t <= end
    return df.where((t >= month.cast("timestamp")) & upper)


# --- rolling anomalies ------------------------------------------------------------------------


def detect_rolling_anomalies(
    df: DataFrame,
    keys: Sequence[str] = (),
    ts: str = "ts",
    value: str = "value",
    window_size: int = 24,
    threshold: float = 6.0,
    min_periods: int | None = None,
    tiebreak: str | None = None,
    target_rows: int | None = None,
) -> DataFrame:
    """Add ``is_anomaly`` to every row by its distance from the rolling median in rolling MADs."""
    if window_size < 3:
        raise ValueError(f"a rolling median needs 3 points or more, not {window_size}")
    names = df.columns
    df, keys = keyed(df, keys)
    need = min_periods or max(3, window_size // 2)
    back = window_size - 1
    rows = positions(df, keys, ts, tiebreak, target_rows=target_rows)
    # The second median looks back over deviations that look back themselves.
    rows, order = halo_blocks(rows, keys, 2 * back, 0, target_rows)
    schema = T.StructType([*[rows.schema[n] for n in names], T.StructField("is_anomaly", T.BooleanType())])

    def flags(block: pa.Table) -> pa.Table:
        block = block.sort_by(POS)
        v = block[value].cast(pa.float64()).to_numpy()
        median, std = _rolling(v, window_size, need)
        dev = np.abs(v - median)
        mad, _ = _rolling(dev, window_size, need)
        with np.errstate(divide="ignore", invalid="ignore"):
            robust = (mad != 0) & (0.6745 * dev / mad > threshold)
            fallback = (np.isnan(mad) | (mad == 0)) & (std != 0) & (dev / std > max(3.0, threshold / 2))
        out = block.select(names).append_column("is_anomaly", pa.array(robust | fallback))
        return out.filter(block[HOME])

    return rows.groupBy(*keys, BLOCK).applyInArrow(flags, schema)


def _rolling(v: np.ndarray, size: int, need: int) -> tuple[np.ndarray, np.ndarray]:
    """Median and deviation of the last ``size`` values at each place; NaN is no value, fewer than ``need`` give NaN."""
    windows = np.lib.stride_tricks.sliding_window_view(np.concatenate([np.full(size - 1, np.nan), v]), size)
    median, std = np.empty(len(v)), np.empty(len(v))
    step = max(1, _WINDOW_CELLS // size)
    for i in range(0, len(v), step):
        # Sorting puts NaN last, so the first k are the values.
        w = np.sort(windows[i : i + step], axis=1)
        k = np.sum(~np.isnan(w), axis=1)
        row = np.arange(len(w))
        low, high = w[row, np.maximum(k - 1, 0) // 2], w[row, np.minimum(k // 2, size - 1)]
        median[i : i + step] = np.where(k >= need, 0.5 * low + 0.5 * high, np.nan)
        with np.errstate(divide="ignore", invalid="ignore"):
            mean = np.nansum(w, axis=1) / k
            spread = np.sqrt(np.nansum((w - mean[:, None]) ** 2, axis=1) / (k - 1))
        std[i : i + step] = np.where((k >= need) & (k > 1), spread, np.nan)
    return median, std


# --- balance and report -----------------------------------------------------------------------


def summarize_flow_balance(line: DataFrame, transformer: DataFrame, tolerance: float = 0.2, keys: Sequence[str] = (), ts: str = "ts", value: str = "value") -> DataFrame:
    """How well two aligned series agree."""
    if tolerance < 0:
        raise ValueError(f"negative tolerance {tolerance}")
    both = align(line, transformer, keys, ts, ("_l", "_t"), value)
    diff = F.abs(F.col("_l") - F.col("_t"))
    rel = diff / F.nullif(F.abs(F.col("_t")), F.lit(0.0))
    inside = F.avg(F.when(rel <= tolerance, 1.0).otherwise(0.0))
    zero = F.lit(0.0)
    out = both.groupBy(*keys).agg(
        F.count("*").alias("points_compared"),
        F.coalesce(F.sum("_l"), zero).alias("line_total"),
        F.coalesce(F.sum("_t"), zero).alias("transformer_total"),
        F.coalesce(F.avg(diff), zero).alias("mean_abs_difference"),
        F.when(F.count("*") == 0, 0.0).otherwise(F.avg(rel)).alias("mean_relative_difference"),
        F.coalesce(inside, zero).alias("within_tolerance_ratio"),
    )
    return out.withColumn("tolerance", F.lit(float(tolerance)))


def quality_control(
    df: DataFrame,
    keys: Sequence[str] = (),
    ts: str = "ts",
    value: str = "value",
    expected_frequency: str = "30min",
    outlier_method: str = "iqr",
    outlier_threshold: float = 3.0,
    target_rows: int | None = None,
) -> DataFrame:
    """One quality row per series. Gap details come from :func:`identify_gaps` as rows of their own."""
    asked = keys
    df, keys = keyed(df, keys)
    df, at_most = sized(df, keys)
    rows = df.select(*dict.fromkeys([*keys, ts, value]))
    stats, flag = _outlier_rule(rows, keys, value, outlier_method, outlier_threshold, target_rows, at_most)
    filled = F.col(value).isNotNull()
    # One layout by series serves the time before each row and all counts.
    rows = previous_time(attach(rows, stats, keys, target_rows, at_most), keys, ts, filled, target_rows, at_most)
    span = F.when(filled, micros(ts) - micros("_before"))
    gap = span > _MIN_GAP_HOURS * _HOUR
    rows = rows.groupBy(*keys).agg(
        F.count("*").alias("total_points"),
        F.count(value).alias("valid_points"),
        F.sum((filled & flag).cast("long")).alias("outlier_points"),
        F.count_if(gap).alias("gap_count"),
        F.coalesce(F.sum(F.when(gap, span / float(_HOUR))), F.lit(0.0)).alias("gap_hours"),
    )
    rows = rows.withColumn("missing_points", F.col("total_points") - F.col("valid_points"))
    zero = F.lit(0).cast("long")
    total, valid = F.col("total_points"), F.col("valid_points")
    missing, outs, n_gaps = F.col("missing_points"), F.col("outlier_points"), F.col("gap_count")
    outlier_pct = 100 * outs / F.greatest(valid, F.lit(1))
    score = F.greatest(
        F.lit(0.0),
        100 * valid / F.nullif(total, zero) - F.least(F.lit(50.0), outlier_pct) - F.least(F.lit(30), n_gaps * 5),
    )
    # The texts of the issues.
    issues = F.array_compact(
        F.array(
            F.when(missing > 0, F.format_string("Missing data: %d points (%.1f%%)", missing, 100 * missing / F.nullif(total, zero))),
            F.when(outs > 0, F.format_string("Outliers detected: %d points (%.1f%%)", outs, outlier_pct)),
            F.when(n_gaps > 0, F.format_string("Data gaps: %d gaps totaling %.1f hours", n_gaps, F.col("gap_hours"))),
        )
    )
    return unkeyed(
        rows.select(
            *keys,
            "total_points",
            "valid_points",
            "missing_points",
            "outlier_points",
            "gap_count",
            "gap_hours",
            F.coalesce(score, F.lit(0.0)).alias("quality_score"),
            issues.alias("issues"),
        ),
        asked,
    )
