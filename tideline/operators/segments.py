"""Segments of a key's events, each closed by a stop event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.stats import erratic_class, merged_stddev
from tideline.functions.time import from_micros, micros, time_type
from tideline.operators.running import Fold, running, time_chunks
from tideline.operators.sessions import collapse_hot
from tideline.operators.skew import HOT, HOT_ROWS, mark_hot


def stop_segments(
    events: DataFrame,
    car: str,
    ts: str,
    speed: str,
    throttle: str,
    is_stop: Column | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Per car, the events up to each stop: start, length, top speed, manner of driving.

    A segment is known by the stop that closes it: the earliest stop at or after the event.
    That is a running minimum over descending time, so segments need no numbering and
    their statistics merge before the shuffle. Stops are not counted, empty segments and the
    events after the last stop give no row.
    """
    kind = time_type(events, ts)
    stop = F.coalesce(is_stop if is_stop is not None else F.col(speed) == 0, F.lit(False))
    at = micros(F.col(ts))
    moving = F.when(stop, F.lit(0)).otherwise(F.lit(1)).cast("long")
    values = {
        "_at": -at,
        # with the stop's own level, which is near those of its segment
        "_stop": F.when(stop, F.struct(at.alias("at"), F.col(throttle).cast("double").alias("near"))),
        "_moving_at": F.when(~stop, at),
        "_n": moving,
        "_speed": F.when(~stop, F.col(speed)),
        "_level": F.when(~stop, F.coalesce(F.col(throttle).cast("double"), F.lit(0.0))),
        "_k": F.when(~stop & F.col(throttle).isNotNull(), 1).otherwise(0).cast("long"),
        "_m2": F.lit(0.0),
    }
    merge = {
        "_stop": F.max("_stop"),
        "_moving_at": F.max("_moving_at"),
        "_n": F.sum("_n"),
        "_speed": F.max("_speed"),
        "_level": F.sum("_level"),
        "_k": F.sum("_k"),
        "_m2": F.coalesce(F.var_pop(F.when(F.col("_k") > 0, F.col("_level"))) * F.sum("_k"), F.lit(0.0)),
    }
    marked = mark_hot(events.filter(F.col(ts).isNotNull()), [car], hot_rows)
    rows = collapse_hot(marked, [car], values, merge)
    rows = rows.withColumn("_after_stop", F.col("_stop").isNull())
    closing = Fold("min", F.col("_stop"))
    order = ["_at", "_after_stop"]
    rows = running(rows, [car], order, {"_closing": closing}, chunks=time_chunks(F.col("_at")))
    segments = (
        rows.filter(F.col("_closing").isNotNull() & (F.col("_n") > 0))
        .groupBy(car, F.col("_closing.at").alias("_closing_at"))
        .agg(
            F.min("_moving_at").alias("_start"),
            F.sum("_n").alias("length"),
            F.max("_speed").alias("max_speed"),
            merged_stddev(
                F.col("_k"),
                F.col("_level"),
                F.col("_m2"),
                F.col("_closing.near"),
                F.col(HOT).isNotNull(),
            ).alias("erraticness"),
        )
    )
    return segments.select(
        car,
        from_micros(F.col("_start"), kind).alias("start_time"),
        from_micros(F.col("_closing_at"), kind).alias("stop_time"),
        "length",
        "max_speed",
        "erraticness",
        erratic_class(F.col("erraticness")).alias("manner"),
    )
