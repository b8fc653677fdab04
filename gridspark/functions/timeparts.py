"""Small helpers for durations and calendar buckets."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Period codes accepted by the redaction summary, as date_trunc units.
PERIOD_UNITS = {"Y": "year", "Q": "quarter", "M": "month", "W": "week", "D": "day", "h": "hour", "H": "hour", "min": "minute"}


def duration_micros(text: str) -> int:
    """``"30min"``, ``"1h"``, ``"1D"`` as microseconds."""
    return int(pd.Timedelta(text).value // 1000)


def micros(ts: str | Column) -> Column:
    """Microseconds since the epoch; naive timestamps are read as UTC session time."""
    return F.unix_micros((F.col(ts) if isinstance(ts, str) else ts).cast("timestamp"))


def from_micros(value: Column, like: DataFrame, ts: str) -> Column:
    """Back to the timestamp type that ``ts`` has in ``like``."""
    return F.timestamp_micros(value.cast("long")).cast(like.schema[ts].dataType)


def truncate(ts: str | Column, unit: str, like: DataFrame, name: str) -> Column:
    """Start of the calendar bucket, in the type of column ``name`` of ``like``."""
    return F.date_trunc(unit, ts).cast(like.schema[name].dataType)


def period_unit(code: str) -> str:
    if code not in PERIOD_UNITS:
        raise ValueError(f"Unknown period: {code}. Use one of {', '.join(PERIOD_UNITS)}.")
    return PERIOD_UNITS[code]
