"""Windows on a time column. All are built from Spark's ``window`` and run on streams as well."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def time_window(
    df: DataFrame,
    ts: str,
    width: str,
    slide: str | None = None,
    keys: Sequence[str] = (),
    **measures: Column,
) -> DataFrame:
    """Aggregate per window (tumbling, or sliding by ``slide``) and key.

    Partial sums are made before the shuffle, so neither a busy window nor a busy key
    concentrates rows. The bounds come out as flat columns.
    """
    span = F.window(ts, width, slide) if slide else F.window(ts, width)
    grouped = df.groupBy(span.alias("_w"), *keys).agg(
        *[measure.alias(name) for name, measure in measures.items()]
    )
    return grouped.select(
        F.col("_w.start").alias("window_start"),
        F.col("_w.end").alias("window_end"),
        *keys,
        *measures,
    )


def window_sum(df, ts: str, key: str, value: str, width: str) -> DataFrame:
    return time_window(df, ts, width, keys=[key], total=F.sum(value))


def window_average(df, ts: str, key: str, value: str, width: str) -> DataFrame:
    return time_window(df, ts, width, keys=[key], average=F.avg(value))


def window_count(
    df, ts: str, width: str, slide: str | None = None, keys: Sequence[str] = ()
) -> DataFrame:
    return time_window(df, ts, width, slide, keys, n=F.count(F.lit(1)))


def window_count_report(df, ts: str, key: str, width: str) -> DataFrame:
    """The count per window and key, and the same as a line of text."""
    counts = window_count(df, ts, width, keys=[key])
    bounds = [F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("window_start", "window_end")]
    report = F.format_string(
        "Window: [%s, %s), key: %s, count: %d", *bounds, F.col(key).cast("string"), F.col("n")
    )
    return counts.withColumn("report", report)


def hourly_tips(fares, ts: str, driver: str, tip: str, width: str = "1 hour") -> DataFrame:
    """Sum of tips per driver and hour."""
    return time_window(fares, ts, width, keys=[driver], tips=F.sum(tip))


def hourly_top_driver(fares, ts: str, driver: str, tip: str, width: str = "1 hour") -> DataFrame:
    """The driver with the largest tips of each hour; of equals, the lowest driver.

    Two levels: per driver and hour, then per hour. The second one also aggregates before its
    shuffle, so it moves one row per hour and task, not one per driver.
    """
    tips = hourly_tips(fares, ts, driver, tip, width)
    return top_per_window(tips, driver)


def top_per_window(tips: DataFrame, driver: str) -> DataFrame:
    best = F.max_by(
        F.struct(driver, "tips"), F.struct(F.col("tips"), (-F.col(driver)).alias("_low"))
    )
    return (
        tips.groupBy("window_start", "window_end")
        .agg(best.alias("_best"))
        .select("window_start", "window_end", f"_best.{driver}", "_best.tips")
    )
