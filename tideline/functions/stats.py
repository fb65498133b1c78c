"""Segment statistics: mergeable moments and the erraticness classes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Width of an erraticness class and the class names.
CLASS_WIDTH = 2.5
CLASS_NAMES = ("calm", "busy", "crazy")


def erratic_class(erraticness: Column) -> Column:
    """Class of a 32-bit erraticness: whole multiples of the class width; none for null."""
    step = F.floor(erraticness.cast("float").cast("double") / CLASS_WIDTH)
    return (
        F.when(step == 0, CLASS_NAMES[0])
        .when(step == 1, CLASS_NAMES[1])
        .when(step.isNotNull(), CLASS_NAMES[2])
    )


def merged_stddev(
    n: Column, total: Column, m2: Column, near: Column, merged: Column
) -> Column:
    """Population standard deviation of a group, null without values, as an aggregate expression.

    Rows are single values or, where ``merged``, parts given by count, sum and M2 (the sum of
    squared differences from the part's own mean). Groups of single values get Spark's own
    deviation. Parts are merged around ``near``, a value of the group: sums of differences from
    it do not cancel as sums of squares do.
    """
    shift = F.coalesce(near, F.lit(0.0))
    off = F.try_divide(total, n) - shift
    count, first = F.sum(n), F.sum(n * off)
    squares = F.sum(m2 + n * off * off) - F.try_divide(first * first, count)
    parts = F.sqrt(F.try_divide(F.greatest(squares, F.lit(0.0)), count))
    # -0.0 and the null of empty groups are left to try_divide
    return F.when(F.max(merged), F.when(count > 0, parts)).otherwise(
        F.stddev_pop(F.when(n > 0, total))
    )
