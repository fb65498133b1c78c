"""Joining two streams on a key: all matches, or one saved row per side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.operators.running import Fold, running
from tideline.operators.skew import HOT, HOT_ROWS, lookup_join, mark_hot


def join_rides_fares(fares: DataFrame, rides: DataFrame, on: Sequence[str]) -> DataFrame:
    """Fares with the ride of the same id; ``rides`` holds one start event per id."""
    return lookup_join(fares, rides, on)


def pair_slots(
    rows: DataFrame, key: str, seq: str, is_left: str, payload: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Pair left and right rows of a key with one saved row at a time, in arrival order.

    An arriving row pairs with the saved row of the other side, which is then forgotten;
    otherwise it is saved itself, in place of an older one of its side. Output: the two
    payloads of each pair and the arrival number that completed it.

    Only maximal runs of same-side rows matter. The first row of a run pairs if the run before
    left a row saved, and then with that run's last row. A run of two or more always leaves
    a row saved; a run of one does so exactly if it found none. As the sides of runs alternate,
    a run finds a saved row exactly if its side is not the side of the last earlier run of two
    or more, or, if there is none, of the first run.
    """
    base = mark_hot(rows.select(key, seq, is_left, payload), [key], hot_rows)
    row = F.struct(F.col(seq), F.col(payload).alias("_payload"))
    seen = running(
        base,
        [key],
        [seq],
        {
            "_left": Fold("max", F.when(F.col(is_left), row)),
            "_right": Fold("max", F.when(~F.col(is_left), row)),
        },
    )
    # All rows of a run have the same last row of the other side before them.
    other = F.when(F.col(is_left), F.col("_right")).otherwise(F.col("_left"))
    runs = (
        seen.groupBy(key, HOT, is_left, other.alias("_saved"))
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.min(F.struct(F.col(seq), F.col(payload).alias("_payload"))).alias("_first"),
        )
        .withColumn(seq, F.col(f"_first.{seq}"))
    )
    side = F.struct(F.col(seq), F.col(is_left).alias("_side"))
    runs = running(
        runs,
        [key],
        [seq],
        {
            "_long": Fold("max", F.when(F.col("_n") >= 2, side), inclusive=False),
            "_begin": Fold("min", side),
        },
    )
    reset = F.coalesce(F.col("_long._side"), F.col("_begin._side"))
    arriving, saved = F.col("_first._payload"), F.col("_saved._payload")
    return runs.filter(F.col(is_left) != reset).select(
        key,
        seq,
        F.when(F.col(is_left), arriving).otherwise(saved).alias(f"left_{payload}"),
        F.when(F.col(is_left), saved).otherwise(arriving).alias(f"right_{payload}"),
    )
