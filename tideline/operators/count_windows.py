"""Windows that are counted in rows, and running folds, per key in arrival order.

``order`` holds the arrival number first; it must be an integer that grows with arrival.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.operators.running import Fold, numbered, running
from tideline.operators.skew import HOT_ROWS


def running_sum(
    df: DataFrame, key: str, order: Sequence[str], value: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Per row, the sum of its key so far."""
    return running(df, [key], order, {"total": Fold("sum", F.col(value))}, hot_rows=hot_rows)


def running_text(
    df: DataFrame, key: str, order: Sequence[str], value: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Per row, all values of its key so far, as "Contains: a and b and c".

    The output of a key is quadratic in its rows by definition; nothing is cut off.
    """
    fold = Fold("text", F.col(value).cast("string"), sep=" and ")
    texts = running(df, [key], order, {"text": fold}, hot_rows=hot_rows)
    return texts.withColumn("text", F.concat(F.lit("Contains: "), F.col("text")))


def count_window_cumulative(
    df: DataFrame, key: str, order: Sequence[str], value: str, every: int, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """At each ``every``-th row of a key, the sum of all its rows so far."""
    folds = {"rn": Fold("sum", F.lit(1).cast("long")), "total": Fold("sum", F.col(value))}
    rows = running(df, [key], order, folds, hot_rows=hot_rows)
    return rows.filter(F.col("rn") % every == 0).select(key, "rn", "total")


def count_window_tumbling(
    df: DataFrame, key: str, order: Sequence[str], value: str, size: int, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Sum and average of each full block of ``size`` rows of a key; an open block gives nothing."""
    rows = numbered(df, [key], order, hot_rows=hot_rows)
    block = F.floor((F.col("rn") - 1) / size).cast("long") + 1
    return (
        rows.groupBy(key, block.alias("block"))
        .agg(
            F.sum(value).alias("total"),
            F.avg(value).alias("average"),
            F.count(F.lit(1)).alias("_n"),
        )
        .filter(F.col("_n") == size)
        .drop("_n")
    )


def count_window_sliding(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    value: str,
    size: int,
    slide: int,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """At each ``slide``-th row of a key, the sum of its last ``size`` rows (fewer at the start).

    A row is copied to the windows it belongs to, at most ceil(size / slide) of them, and the
    copies are summed before they move.
    """
    rows = numbered(df, [key], order, hot_rows=hot_rows)
    first = F.ceil(F.col("rn") / slide).cast("long") * slide
    last = F.col("rn") + (size - 1)
    fires = F.when(first <= last, F.sequence(first, last, F.lit(slide).cast("long")))
    return (
        rows.select(key, "rn", value, F.explode(fires).alias("fire"))
        .groupBy(key, "fire")
        .agg(F.sum(value).alias("total"), F.max("rn").alias("_last"))
        .filter(F.col("_last") == F.col("fire"))
        .select(key, F.col("fire").alias("rn"), "total")
    )


def count_average(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    value: str,
    size: int = 3,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Average of every ``size`` values of a key."""
    blocks = count_window_tumbling(df, key, order, value, size, hot_rows)
    return blocks.select(key, "block", "average")


def sink_batches(df: DataFrame, order: Sequence[str], size: int, start: int = 0) -> DataFrame:
    """Number the rows of the whole table in ``order`` into batches of ``size``; the last may
    be shorter. ``start`` rows came before."""
    rows = numbered(df, [], order, "_rn")
    return rows.withColumn("batch_no", F.expr(f"(_rn + {start - 1}L) div {size}")).drop("_rn")
