"""Hot keys: finding them, and joining rows that have them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT = "_hot"
HOT_ROWS = 1 << 20


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Hashes of the keys that hold more than ``hot_rows`` rows.

    One column-pruned pass with map-side counts. Each row of the result stands for more than
    ``hot_rows`` input rows, so N input rows give fewer than N / hot_rows hashes of 8 bytes
    (10^12 rows: under one million, 8 MB). That bound is what allows the broadcasts below.
    A hash clash only makes a small key count as hot, which is harmless.
    """
    return (
        df.groupBy(F.xxhash64(*keys).alias("_hash"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .filter(F.col("_rows") > hot_rows)
        .select("_hash")
    )


def mark_hot(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add ``_hot``: the key's hash in rows of hot keys, else null. A null key is a key."""
    hot = hot_keys(df, keys, hot_rows).withColumn(HOT, F.col("_hash"))
    return (
        df.withColumn("_hash", F.xxhash64(*keys))
        .join(F.broadcast(hot), "_hash", "left")
        .drop("_hash")
    )


def lookup_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Join many rows (left) with a side of few rows per key (right).

    Both sides are read once. Spark broadcasts the right side if its measured size is below the
    broadcast threshold; otherwise both are shuffled, and a key that is hot on the left is split
    over tasks at run time (adaptive skew join).
    """
    return left.join(right, list(on), how)
