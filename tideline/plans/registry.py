"""Where queries register themselves under their function names."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.session import use_utc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql.strip()
        return function

    return register


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    use_utc(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def cents(value: str) -> Column:
    """Money as whole cents, so that sums are exact."""
    return F.round(F.col(value) * 100).cast("long")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table with exact cents beside the value."""
    return load(spark, sf_dir, "events").withColumn("cents", cents("value"))


EVENTS_SQL = "(SELECT *, CAST(round(value * 100) AS BIGINT) AS cents FROM events)"


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events in a disturbed arrival order (seq, event_id)."""
    shift = (F.col("event_id") * 7919) % 23
    return events(spark, sf_dir).withColumn("seq", F.col("event_id") + shift)


ARRIVALS_SQL = f"(SELECT *, event_id + (event_id * 7919) % 23 AS seq FROM {EVENTS_SQL})"
ARRIVAL = ["seq", "event_id"]
