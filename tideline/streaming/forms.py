"""Operators on streaming tables. Each returns a streaming table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.stats import erratic_class
from tideline.functions.time import from_micros, micros, time_type
from tideline.operators import time_windows as tw
from tideline.streaming import processors as p


def keyed(
    rows: DataFrame,
    key: str,
    processor: p.Ordered,
    output: T.StructType | str,
    time_mode: str = "None",
    ttl_ms: int | None = None,
) -> DataFrame:
    """Run a processor per key; ``output`` lists the columns after the key.

    State lasts forever unless ``ttl_ms`` is given: then a key's state is dropped that long
    (wall clock) after its last change, which keeps the state of an endless stream bounded.
    Start the stream by ``session.start_keyed``, which chooses the state store that keyed state
    needs where the session leaves it open. Wall-clock state (this and ``idle_count``) needs a trigger with an interval; a stream that
    is to end when its input does never finds that there is nothing left to do.
    """
    if ttl_ms is not None:
        processor.ttl_ms, time_mode = ttl_ms, "ProcessingTime"
    added = T.StructType.fromDDL(output) if isinstance(output, str) else output
    schema = T.StructType([rows.schema[key], *added.fields])
    processor.names = schema.fieldNames()
    return rows.groupBy(key).transformWithStateInPandas(
        statefulProcessor=processor,
        outputStructType=schema,
        outputMode="append",
        timeMode=time_mode,
    )


def _numbers(rows: DataFrame, value: str) -> tuple[DataFrame, T.DataType]:
    """A value column without nulls (see ``processors.GIVEN``), and the type of its sums: whole
    numbers stay whole, all others become doubles."""
    whole = isinstance(rows.schema[value].dataType, T.IntegralType)
    kind = T.LongType() if whole else T.DoubleType()
    number = F.coalesce(F.col(value).cast(kind), F.lit(0).cast(kind))
    return rows.withColumns({p.GIVEN: F.col(value).isNotNull(), value: number}), kind


def _columns(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns])


def count_average(
    rows,
    key: str,
    order: Sequence[str],
    value: str,
    size: int = 3,
    store: str = "value",
    ttl_ms: int | None = None,
):
    """Average of every ``size`` values of a key, with one of three kinds of state."""
    processor = p.BlockAverage(order, value, size, store)
    given, _ = _numbers(rows.select(key, *order, value), value)
    return keyed(given, key, processor, processor.OUTPUT, ttl_ms=ttl_ms)


def count_window(
    rows,
    key: str,
    order: Sequence[str],
    value: str,
    every: int,
    size: int | None = None,
    ttl_ms: int | None = None,
):
    """Counted windows: cumulative without ``size``, tumbling if equal, else sliding."""
    given, kind = _numbers(rows.select(key, *order, value), value)
    processor = p.CountWindow(order, value, every, size, kind)
    output = _columns(("rn", T.LongType()), ("total", kind))
    return keyed(given, key, processor, output, ttl_ms=ttl_ms)


def running_fold(
    rows,
    key: str,
    order: Sequence[str],
    value: str,
    with_text: bool = True,
    ttl_ms: int | None = None,
):
    """Running sum, and running text, per row."""
    words = F.col(value).cast("string") if with_text else F.lit(None).cast("string")
    given, kind = _numbers(rows.select(key, *order, value, words.alias("words")), value)
    processor = p.RunningFold(order, value, with_text, kind)
    output = _columns(("seq", T.LongType()), ("total", kind), ("text", T.StringType()))
    return keyed(given, key, processor, output, ttl_ms=ttl_ms)


def idle_count(rows, key: str, idle_ms: int):
    """Rows per key, once it has been idle (wall clock)."""
    processor = p.IdleCount(idle_ms)
    return keyed(rows.select(key), key, processor, processor.OUTPUT, "ProcessingTime")


def blocklist(
    words: DataFrame,
    control: DataFrame,
    on: str,
    seq: str,
    keep: Sequence[str],
    ttl_ms: int | None = None,
):
    """Words whose key no control row named before, in arrival order."""
    others = [c for c in keep if c != seq]
    tagged = words.select(on, seq, F.lit(False).alias("control_"), *others)
    names = control.select(
        on,
        seq,
        F.lit(True).alias("control_"),
        *[F.lit(None).cast(words.schema[c].dataType).alias(c) for c in others],
    )
    # kept columns travel as text, in which whole numbers and nulls go side by side
    fields = ", ".join(f"{c} string" for c in keep)
    kinds = {c: words.schema[c].dataType for c in keep}
    # Of equals in arrival, the control row counts as first.
    rows = tagged.unionByName(names).withColumn("last_", F.when(F.col("control_"), 0).otherwise(1))
    texts = rows.select(
        on, seq, "control_", "last_", *[F.col(c).cast("string").alias(f"of_{c}_") for c in keep]
    )
    processor = p.BlockList([seq, "last_"], "control_", [f"of_{c}_" for c in keep])
    passed = keyed(texts, on, processor, fields, ttl_ms=ttl_ms)
    return passed.select(on, *[F.col(c).cast(kind).alias(c) for c, kind in kinds.items()])


def pair_slots(
    rows, key: str, seq: str, is_left: str, payload: str, ttl_ms: int | None = None
):
    """Pairs with one saved row per side, over the union of both sides."""
    processor = p.Slots([seq], is_left, payload, rows.schema[payload].dataType)
    kind = processor.kind.simpleString()
    output = f"{seq} long, left_{payload} {kind}, right_{payload} {kind}"
    given = F.col(payload).isNotNull().alias(p.GIVEN)
    value = F.col(payload)
    if isinstance(rows.schema[payload].dataType, T.IntegralType):
        value = F.coalesce(value, F.lit(0)).cast(processor.kind).alias(payload)
    columns = rows.select(key, seq, is_left, value, given)
    return keyed(columns, key, processor, output, ttl_ms=ttl_ms)


def join_rides_fares(rides, fares, on: str, ride_ts: str, fare_ts: str, within: str):
    """Rides and fares of one id whose times lie at most ``within`` apart.

    The bound, with a watermark on both sides, lets Spark forget rows that cannot match any more.
    """
    r = rides.withWatermark(ride_ts, within).alias("r")
    f = fares.withWatermark(fare_ts, within).alias("f")
    span = F.expr(f"INTERVAL {within}")
    near = (F.col(f"f.{fare_ts}") >= F.col(f"r.{ride_ts}") - span) & (
        F.col(f"f.{fare_ts}") <= F.col(f"r.{ride_ts}") + span
    )
    same = F.col(f"r.{on}") == F.col(f"f.{on}")
    return r.join(f, same & near, "inner").drop(F.col(f"f.{on}"))


def driving_sessions(events, car: str, ts: str, speed: str, throttle: str, gap: str, delay: str):
    """Sessions of a car in append mode, once the watermark has closed them."""
    span = F.session_window(ts, gap)
    found = (
        events.withWatermark(ts, delay)
        .groupBy(car, span.alias("_w"))
        .agg(
            F.count(F.lit(1)).alias("length"),
            F.max(speed).alias("max_speed"),
            F.stddev_pop(throttle).alias("erraticness"),
        )
    )
    return found.select(
        car,
        F.col("_w.start").alias("session_start"),
        F.col("_w.end").alias("session_end"),
        "length",
        "max_speed",
        "erraticness",
        erratic_class(F.col("erraticness")).alias("manner"),
    )


def dynamic_sessions(events, key: str, ts: str, gap, total: str, delay: str):
    """Sessions with a gap per row (``gap`` yields an interval or its text)."""
    found = (
        events.withWatermark(ts, delay)
        .groupBy(key, F.session_window(ts, gap).alias("_w"))
        .agg(F.count(F.lit(1)).alias("length"), F.sum(total).alias("total"))
    )
    bounds = [F.col("_w.start").alias("session_start"), F.col("_w.end").alias("session_end")]
    return found.select(key, *bounds, "length", "total")


def hourly_top_driver(fares, ts: str, driver: str, tip: str, delay: str, width: str = "1 hour"):
    """Top driver of each closed hour: two chained windows in append mode."""
    first = (
        fares.withWatermark(ts, delay)
        .groupBy(F.window(ts, width).alias("_w"), driver)
        .agg(F.sum(tip).alias("tips"))
    )
    hours = first.select(F.window_time("_w").alias("_at"), driver, "tips")
    best = F.max_by(
        F.struct(driver, "tips"), F.struct(F.col("tips"), (-F.col(driver)).alias("_low"))
    )
    top = hours.groupBy(F.window("_at", width).alias("_w")).agg(best.alias("_best"))
    return top.select(
        F.col("_w.start").alias("window_start"),
        F.col("_w.end").alias("window_end"),
        f"_best.{driver}",
        "_best.tips",
    )


def window_count(rows, ts: str, delay: str, width: str, slide: str | None = None, keys=()):
    """Counts per window and key, after the watermark has closed the window."""
    return tw.window_count(rows.withWatermark(ts, delay), ts, width, slide, keys)


def with_heartbeat(rows: DataFrame, beats: DataFrame, ts: str) -> DataFrame:
    """Rows and beats in one stream, told apart by ``is_beat``; a beat has a time and nothing else.

    Spark's watermark moves with rows only, so the windows of a source that falls idle stay open.
    Beats (of the ``rate`` source, say, or of any stream that goes on) move it without them: put the
    watermark on this stream and leave beats out of what is counted, not out of the stream.
    """
    kind = rows.schema[ts].dataType
    beat = beats.select(F.col(ts).cast(kind).alias(ts), F.lit(True).alias("is_beat"))
    return rows.withColumn("is_beat", F.lit(False)).unionByName(beat, allowMissingColumns=True)


def live_window_count(
    rows: DataFrame, beats: DataFrame, ts: str, delay: str, width: str, keys: Sequence[str] = ()
) -> DataFrame:
    """Counts per window and key that come out also after the rows have stopped."""
    both = with_heartbeat(rows, beats, ts).withWatermark(ts, delay)
    real = F.count(F.when(~F.col("is_beat"), 1))
    return tw.time_window(both, ts, width, keys=keys, n=real).filter("n > 0")


def stop_segments(events, car: str, ts: str, speed: str, throttle: str, delay: str, is_stop=None):
    """Segments closed by a stop, once the watermark has passed the stop."""
    kind = time_type(events, ts)
    stop = F.coalesce(is_stop if is_stop is not None else F.col(speed) == 0, F.lit(False))
    rows = events.withWatermark(ts, delay).filter(F.col(ts).isNotNull())
    rows = rows.select(
        car,
        ts,
        micros(F.col(ts)).alias("at"),
        stop.alias("is_stop"),
        F.col(speed).cast("double").alias("speed"),
        F.col(throttle).cast("double").alias("throttle"),
    )
    found = keyed(rows, car, p.StopSegments(), p.StopSegments.OUTPUT, "EventTime")
    return found.select(
        car,
        from_micros(F.col("start_at"), kind).alias("start_time"),
        from_micros(F.col("stop_at"), kind).alias("stop_time"),
        "length",
        "max_speed",
        "erraticness",
        erratic_class(F.col("erraticness")).alias("manner"),
    )
