"""Taxi rides: city filter, map cells, counts per driver, longest trips."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.functions.geo import grid_cell, in_city
from tideline.functions.time import SECOND, micros
from tideline.operators.running import Fold, running
from tideline.operators.skew import HOT_ROWS


def rides_in_city(rides: DataFrame) -> DataFrame:
    """Rides that start and end inside the city box."""
    starts = in_city(F.col("start_lon"), F.col("start_lat"))
    return rides.filter(starts & in_city(F.col("end_lon"), F.col("end_lat")))


def with_cells(rides: DataFrame) -> DataFrame:
    """Add the map cells of both ends."""
    return rides.withColumns(
        {
            "start_cell": grid_cell(F.col("start_lon"), F.col("start_lat")),
            "end_cell": grid_cell(F.col("end_lon"), F.col("end_lat")),
        }
    )


def rides_enriched(rides: DataFrame) -> DataFrame:
    """City rides with their cells; parse, filter and cells run as one stage."""
    return with_cells(rides_in_city(rides))


def ride_count(
    rides: DataFrame, driver: str = "driver_id", is_start: str = "is_start"
) -> DataFrame:
    """Start events per driver."""
    return rides.filter(is_start).groupBy(driver).agg(F.count(F.lit(1)).alias("n"))


def trip_minutes(
    rides: DataFrame,
    start: str = "start_time",
    end: str = "end_time",
    is_start: str | None = "is_start",
) -> tuple[DataFrame, DataFrame]:
    """End events with their whole minutes, and the rejects that end before they start."""
    ends = rides.filter(~F.col(is_start)) if is_start else rides
    length = micros(F.col(end)) - micros(F.col(start))
    good = ends.filter(length >= 0).withColumn(
        "minutes", F.floor(length / (60 * SECOND)).cast("long")
    )
    return good, ends.filter(F.coalesce(length < 0, F.lit(True)))


def longest_trip(trips: DataFrame, cell: str = "start_cell") -> DataFrame:
    """Longest trip per start cell."""
    return trips.groupBy(cell).agg(F.max("minutes").alias("minutes"))


def longest_trip_running(
    trips: DataFrame, cell: str, order: list[str], hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Per trip, the longest trip of its cell so far."""
    return running(
        trips, [cell], order, {"longest": Fold("max", F.col("minutes"))}, hot_rows=hot_rows
    )
