"""Schemas of the event records (UTC timestamps; names in snake case)."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


RIDE = _struct(
    ("ride_id", T.LongType()),
    ("is_start", T.BooleanType()),
    ("start_time", T.TimestampType()),
    ("end_time", T.TimestampType()),
    ("start_lon", T.FloatType()),
    ("start_lat", T.FloatType()),
    ("end_lon", T.FloatType()),
    ("end_lat", T.FloatType()),
    ("passenger_cnt", T.ShortType()),
    ("taxi_id", T.LongType()),
    ("driver_id", T.LongType()),
)

FARE = _struct(
    ("ride_id", T.LongType()),
    ("taxi_id", T.LongType()),
    ("driver_id", T.LongType()),
    ("start_time", T.TimestampType()),
    ("payment_type", T.StringType()),
    ("tip", T.FloatType()),
    ("tolls", T.FloatType()),
    ("total_fare", T.FloatType()),
)

CAR_EVENT = _struct(
    ("car_id", T.StringType()),
    ("id", T.StringType()),
    ("consumption", T.FloatType()),
    ("speed", T.FloatType()),
    ("throttle", T.FloatType()),
    ("engineload", T.FloatType()),
    ("longitude", T.FloatType()),
    ("latitude", T.FloatType()),
    ("ts", T.TimestampType()),
)
