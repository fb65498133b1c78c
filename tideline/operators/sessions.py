"""Sessions: rows of a key whose time spans [ts, ts + gap] touch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.stats import erratic_class, merged_stddev
from tideline.functions.time import from_micros, micros, time_type
from tideline.operators.running import Fold, running, time_chunks, with_chunks
from tideline.operators.skew import HOT, HOT_ROWS, mark_hot


def collapse_hot(
    df: DataFrame, keys: Sequence[str], values: dict[str, Column], merge: dict[str, Column]
) -> DataFrame:
    """Rows as (keys, values), the rows of hot keys merged where ``keys`` + ``_at`` agree.

    ``values`` are the row's columns, ``merge`` the aggregate of each over equal rows. After
    that ``_at`` does not repeat within a hot key, so time chunks of it are bounded even if
    very many rows share one moment. Partial merges run before the shuffle.
    """
    rows = df.select(*keys, HOT, *[value.alias(name) for name, value in values.items()])
    hot = (
        rows.filter(F.col(HOT).isNotNull())
        .groupBy(*keys, HOT, "_at")
        .agg(*[merge[name].alias(name) for name in values if name != "_at"])
    )
    return rows.filter(F.col(HOT).isNull()).unionByName(hot)


def sessions(
    df: DataFrame,
    key: str,
    ts: str,
    gap: Column,
    *,
    peak: Column | None = None,
    level: Column | None = None,
    total: Column | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """One row per session: start, end (last ts + gap), length, and on demand

    ``max_peak``, ``total`` (sum) and the population deviation ``erraticness`` of ``level``.
    ``gap`` is in microseconds and may differ per row. Spans that only touch merge.
    """
    kind = time_type(df, ts)
    one = F.lit(1).cast("long")
    at = micros(F.col(ts))
    number = (level if level is not None else F.lit(0)).cast("double")
    amount = total if total is not None else F.lit(0).cast("long")
    height = peak if peak is not None else F.lit(0)
    values = {
        "_at": at,
        "_reach": at + gap,
        "_n": one,
        "_peak": height,
        "_level": F.coalesce(number, F.lit(0.0)),
        "_k": F.when(number.isNotNull(), one).otherwise(one - 1),
        "_m2": F.lit(0.0),
        "_total": amount,
    }
    merge = {
        "_reach": F.max("_reach"),
        "_n": F.sum("_n"),
        "_peak": F.max("_peak"),
        "_level": F.sum("_level"),
        "_k": F.sum("_k"),
        "_m2": F.coalesce(F.var_pop(F.when(F.col("_k") > 0, F.col("_level"))) * F.sum("_k"), F.lit(0.0)),
        "_total": F.sum("_total"),
    }
    marked = mark_hot(df.filter(F.col(ts).isNotNull()), [key], hot_rows)
    rows = collapse_hot(marked, [key], values, merge)
    reach = Fold("max", F.col("_reach"), inclusive=False)
    rows = with_chunks(rows, [key], time_chunks(F.col("_at")))
    rows = running(rows, [key], ["_at"], {"_reached": reach})
    opens = F.when(F.col("_reached").isNull() | (F.col("_at") > F.col("_reached")), F.col("_at"))
    # a session is known by its first row, whose level is near the others
    mean = F.try_divide("_level", "_k")
    first = F.when(opens.isNotNull(), F.struct(F.col("_at"), mean.alias("_near")))
    rows = running(rows, [key], ["_at"], {"_first": Fold("max", first)})
    rows = rows.select("*", F.col("_first._at").alias("_start"), "_first._near")
    out = rows.groupBy(key, "_start").agg(
        F.max("_reach").alias("_end"),
        F.sum("_n").alias("length"),
        F.max("_peak").alias("max_peak"),
        F.sum("_total").alias("total"),
        merged_stddev(
            F.col("_k"), F.col("_level"), F.col("_m2"), F.col("_near"), F.col(HOT).isNotNull()
        ).alias("erraticness"),
    )
    columns = [
        F.col(key),
        from_micros(F.col("_start"), kind).alias("session_start"),
        from_micros(F.col("_end"), kind).alias("session_end"),
        F.col("length"),
    ]
    if peak is not None:
        columns.append(F.col("max_peak"))
    if total is not None:
        columns.append(F.col("total"))
    if level is not None:
        columns.append(F.col("erraticness"))
    return out.select(*columns)


def driving_sessions(
    events: DataFrame,
    car: str,
    ts: str,
    speed: str,
    throttle: str,
    gap_micros: int,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Driving sessions of a car: all events, stops included, up to a pause longer than the gap."""
    found = sessions(
        events,
        car,
        ts,
        F.lit(gap_micros).cast("long"),
        peak=F.col(speed),
        level=F.col(throttle),
        hot_rows=hot_rows,
    )
    return found.withColumnRenamed("max_peak", "max_speed").withColumn(
        "manner", erratic_class(F.col("erraticness"))
    )
