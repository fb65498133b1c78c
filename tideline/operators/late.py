"""Event time against arrival order: the watermark, late rows, the event sorter.

Spark's own watermark moves once per micro-batch and drops late rows without a trace. Here
the watermark is a column: before a row it is the largest event time of all rows that arrived
earlier, minus the delay. ``order`` gives the arrival order, an integer column first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.time import clock, from_micros, micros, time_type
from tideline.operators.running import Fold, numbered, running
from tideline.operators.skew import HOT_ROWS

MILLI = 1000


def with_watermark_column(
    df: DataFrame,
    ts: str,
    order: Sequence[str],
    delay_micros: int,
    marker: Column | None = None,
    start: Column | None = None,
) -> DataFrame:
    """Add ``_mark``, the watermark before each row in microseconds (null before the first).

    ``marker`` limits the rows that move it; ``start`` is the largest event time of earlier data.
    """
    at = micros(F.col(ts))
    moves = F.when(marker, at) if marker is not None else at
    seen = running(df, [], order, {"_mark": Fold("max", moves, inclusive=False)})
    mark = F.greatest(F.col("_mark"), start) if start is not None else F.col("_mark")
    return seen.withColumn("_mark", mark - delay_micros)


def late_rows(
    df: DataFrame,
    ts: str,
    order: Sequence[str],
    width_micros: int,
    delay_micros: int,
    lateness_micros: int = 0,
    marker: Column | None = None,
    start: Column | None = None,
) -> DataFrame:
    """Add ``window_start``, ``window_end`` and ``late``: the row's tumbling window was closed
    when it arrived. A window closes when the watermark reaches its last millisecond, plus
    the allowed lateness."""
    kind = time_type(df, ts)
    at = micros(F.col(ts))
    begin = at - F.pmod(at, F.lit(width_micros))
    end = begin + width_micros
    closed = end - MILLI + lateness_micros <= F.col("_mark")
    marked = with_watermark_column(df, ts, order, delay_micros, marker, start)
    return marked.withColumns(
        {
            "window_start": from_micros(begin, kind),
            "window_end": from_micros(end, kind),
            "late": F.coalesce(closed, F.lit(False)),
        }
    ).drop("_mark")


def late_split(df: DataFrame, *args, **options) -> tuple[DataFrame, DataFrame]:
    """The rows that arrived in time, and the late ones."""
    rows = late_rows(df, *args, **options)
    return rows.filter(~F.col("late")).drop("late"), rows.filter(F.col("late")).drop("late")


def late_text(late: DataFrame, key: str, ts: str) -> DataFrame:
    """Late rows as lines of text."""
    epoch_ms = F.floor(micros(F.col(ts)) / MILLI).cast("long")
    pair = F.format_string("late: (%s,%d)", F.col(key).cast("string"), epoch_ms)
    return late.withColumn("text", pair)


def element_text(key: str, ts: str) -> Column:
    """An element as "(key,epoch ms)|clock time", in a column ``text``."""
    epoch_ms = F.floor(micros(F.col(ts)) / MILLI).cast("long")
    return F.format_string(
        "(%s,%d)|%s", F.col(key).cast("string"), epoch_ms, clock(F.col(ts))
    ).alias("text")


def window_element_rows(
    on_time: DataFrame, key: str, ts: str, order: Sequence[str], hot_rows: int = HOT_ROWS
) -> DataFrame:
    """One row per element of each key and window: its ``pos`` from 1 in arrival order, and its
    ``text``. This is the form for windows of any size."""
    keys = [key, "window_start", "window_end"]
    elements = on_time.select(*keys, *order, element_text(key, ts))
    return numbered(elements, keys, order, "pos", hot_rows=hot_rows)


def window_elements(on_time: DataFrame, key: str, ts: str, order: Sequence[str]) -> DataFrame:
    """The elements of each key and window as one text, in arrival order, with their clock
    times. A window's whole list is in one cell: see :func:`window_element_rows` for rows."""
    keys = [key, "window_start", "window_end"]
    elements = on_time.select(*keys, F.struct(*order, element_text(key, ts)).alias("_element"))
    listed = F.sort_array(F.collect_list("_element"))
    return elements.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.array_join(F.transform(listed, lambda e: e["text"]), ", ").alias("elements"),
    )


def sorter_rows(
    df: DataFrame,
    ts: str,
    order: Sequence[str],
    delay_micros: int,
    start: Column | None = None,
) -> DataFrame:
    """Add ``late``: the event time was at or below the watermark when the row arrived."""
    rows = with_watermark_column(df, ts, order, delay_micros, start=start)
    late = F.coalesce(micros(F.col(ts)) <= F.col("_mark"), F.lit(False))
    return rows.withColumn("late", late).drop("_mark")


def sorter_split(
    df: DataFrame, ts: str, order: Sequence[str], delay_micros: int
) -> tuple[DataFrame, DataFrame]:
    """Rows in time for the sorter, and the late ones."""
    rows = sorter_rows(df, ts, order, delay_micros)
    return rows.filter(~F.col("late")).drop("late"), rows.filter(F.col("late")).drop("late")


def car_sort(
    df: DataFrame, car: str, ts: str, order: Sequence[str], delay_micros: int
) -> DataFrame:
    """On-time events of each car in event-time order.

    A range partitioning on (car, ts, arrival) cuts a busy car's events over several tasks.
    """
    on_time, _ = sorter_split(df, ts, order, delay_micros)
    return on_time.orderBy(car, ts, *order)


def car_late_ids(
    df: DataFrame, event_id: str, ts: str, order: Sequence[str], delay_micros: int
) -> DataFrame:
    """Ids of the events that came too late to be sorted in."""
    _, late = sorter_split(df, ts, order, delay_micros)
    return late.select(event_id)
