"""Time expressions on integer microseconds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SECOND = 1_000_000
HOUR = 3600 * SECOND


def micros(ts: Column) -> Column:
    """Microseconds since the epoch (session time zone UTC)."""
    return F.unix_micros(ts.cast("timestamp"))


def from_micros(value: Column, kind: T.DataType | str = "timestamp") -> Column:
    return F.timestamp_micros(value).cast(kind)


def time_type(df: DataFrame, ts: str) -> T.DataType:
    return df.schema[ts].dataType


def clock(ts: Column) -> Column:
    return F.date_format(ts, "HH:mm:ss")
