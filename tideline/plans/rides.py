"""Taxi records, made from the order tables: text forms, map cells, joins."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.geo import grid_cell
from tideline.operators import pairing
from tideline.operators import rides as ops
from tideline.operators.skew import lookup_join
from tideline.plans import cars
from tideline.plans.registry import SQL, cents, events, load, query
from tideline.session import work_folder
from tideline.sources import records
from tideline.sources.lines import read_lines


def _lon(key: str):
    return (F.lit(-74.10) + (F.col(key) % 500) * F.lit(0.001)).cast("float")


def _lat(key: str):
    return (F.lit(40.45) + (F.col(key) % 700) * F.lit(0.001)).cast("float")


def _lon_sql(key: str) -> str:
    return f"CAST(CAST(-74.10 AS DOUBLE) + ({key} % 500) * CAST(0.001 AS DOUBLE) AS FLOAT)"


def _lat_sql(key: str) -> str:
    return f"CAST(CAST(40.45 AS DOUBLE) + ({key} % 700) * CAST(0.001 AS DOUBLE) AS FLOAT)"


def rides(spark, sf_dir):
    """One ride event per order line."""
    shipped = F.col("l_shipdate").cast("timestamp")
    return load(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("ride_id"),
        (F.col("l_returnflag") == "A").alias("is_start"),
        shipped.alias("start_time"),
        (shipped + F.make_dt_interval(mins=F.col("l_linenumber"))).alias("end_time"),
        _lon("l_orderkey").alias("start_lon"),
        _lat("l_orderkey").alias("start_lat"),
        _lon("l_partkey").alias("end_lon"),
        _lat("l_partkey").alias("end_lat"),
        F.col("l_linenumber").cast("short").alias("passenger_cnt"),
        F.col("l_partkey").alias("taxi_id"),
        F.col("l_suppkey").alias("driver_id"),
    )


_RIDES = f"""(SELECT l_orderkey AS ride_id, l_returnflag = 'A' AS is_start,
    l_shipdate AS start_time, l_shipdate + to_minutes(l_linenumber) AS end_time,
    {_lon_sql("l_orderkey")} AS start_lon, {_lat_sql("l_orderkey")} AS start_lat,
    {_lon_sql("l_partkey")} AS end_lon, {_lat_sql("l_partkey")} AS end_lat,
    CAST(l_linenumber AS SMALLINT) AS passenger_cnt, l_partkey AS taxi_id,
    l_suppkey AS driver_id FROM lineitem)"""

_PLACES = ["start_lon", "start_lat", "end_lon", "end_lat"]


def _readable_rides(df):
    """Coordinates to three places, times without zone."""
    changed = {c: F.round(F.col(c).cast("double"), 3) for c in _PLACES}
    changed |= {c: F.col(c).cast("timestamp_ntz") for c in ("start_time", "end_time")}
    return df.withColumns(changed)


def _rounded(columns) -> str:
    return ", ".join(f"round(CAST({c} AS DOUBLE), 3) AS {c}" for c in columns)


_RIDE_COLUMNS = f"""ride_id, is_start, start_time, end_time, {_rounded(_PLACES)},
    passenger_cnt, taxi_id, driver_id"""


@query(f"SELECT {_RIDE_COLUMNS} FROM {_RIDES}")
def parse_rides(spark, sf_dir):
    """Rides to lines and back."""
    good, _ = records.parse_rides(records.format_rides(rides(spark, sf_dir)))
    return _readable_rides(good)


# The city box and the cell arithmetic, written out once for the SQL side.
def _in_city_sql(lon: str, lat: str) -> str:
    return (
        f"CAST({lon} AS DOUBLE) BETWEEN -74.05 AND -73.7 "
        f"AND CAST({lat} AS DOUBLE) BETWEEN 40.5 AND 41.0"
    ).replace("-74.05", "CAST(-74.05 AS DOUBLE)").replace("-73.7", "CAST(-73.7 AS DOUBLE)")


def _cell_sql(lon: str, lat: str) -> str:
    return (
        f"CAST(floor((CAST(74.05 AS DOUBLE) - abs(CAST({lon} AS DOUBLE))) / CAST(0.0014 AS DOUBLE))"
        f" + 250 * floor((CAST(41.0 AS DOUBLE) - CAST({lat} AS DOUBLE)) / CAST(0.00125 AS DOUBLE))"
        " AS INTEGER)"
    )


_CITY = (
    f"{_in_city_sql('start_lon', 'start_lat')} AND {_in_city_sql('end_lon', 'end_lat')}"
)


@query(f"SELECT {_RIDE_COLUMNS} FROM {_RIDES} WHERE {_CITY}")
def rides_in_city(spark, sf_dir):
    return _readable_rides(ops.rides_in_city(rides(spark, sf_dir)))


@query(
    f"""SELECT {_RIDE_COLUMNS}, {_cell_sql("start_lon", "start_lat")} AS start_cell,
        {_cell_sql("end_lon", "end_lat")} AS end_cell FROM {_RIDES} WHERE {_CITY}"""
)
def rides_enriched(spark, sf_dir):
    return _readable_rides(ops.rides_enriched(rides(spark, sf_dir)))


@query(
    f"""SELECT start_cell, max(epoch_us(end_time) - epoch_us(start_time)) // 60000000 AS minutes
        FROM (SELECT *, {_cell_sql("start_lon", "start_lat")} AS start_cell FROM {_RIDES} WHERE {_CITY})
        WHERE NOT is_start GROUP BY start_cell"""
)
def city_longest_trip(spark, sf_dir):
    """From lines to the longest trip of each cell: parse, city, cells, end events."""
    good, _ = records.parse_rides(records.format_rides(rides(spark, sf_dir)))
    trips, _ = ops.trip_minutes(ops.rides_enriched(good))
    return ops.longest_trip(trips)


def _damaged(lines, key, damages: dict[int, tuple[str, str]]):
    """Every seventh line, by its key, damaged in each way: a pattern and what replaces it."""
    value, number = F.col("value"), F.col("number")
    for rest, (pattern, new) in damages.items():
        value = F.when(number % 7 == rest, F.regexp_replace("value", pattern, new)).otherwise(value)
    numbered = lines.withColumn("number", F.regexp_extract("value", key, 1).cast("long"))
    return numbered.select("number", value.alias("value"))


_REJECTED = """SELECT '{kind}' AS kind, CASE {key} % 7 WHEN 0 THEN 'tokens: {tokens}'
    WHEN 1 THEN 'unreadable field' ELSE 'unknown event kind' END AS reason,
    count(*) AS n, CAST(sum({key}) AS BIGINT) AS total FROM {table} WHERE {key} % 7 <= {last} GROUP BY ALL"""


@query(
    " UNION ALL ".join(
        _REJECTED.format(kind=kind, key=key, table=table, tokens=tokens, last=last)
        for kind, key, table, tokens, last in (
            ("ride", "l_orderkey", "lineitem", 10, 2),
            ("fare", "o_orderkey", "orders", 7, 1),
            ("car", "event_id", "events", 22, 1),
        )
    )
)
def parse_rejects(spark, sf_dir):
    """Lines that lack a token, hold no time or an unknown kind, with the reason."""
    shorter = (r"[,;]\s*[^,;]*$", "")
    ride_lines = _damaged(
        records.format_rides(rides(spark, sf_dir)),
        r"^(\d+),",
        {0: shorter, 1: (r"^((?:[^,]*,){2})[^,]*", "$1never"), 2: ("START|END", "STOP")},
    )
    fare_lines = _damaged(
        records.format_fares(fares(spark, sf_dir)),
        r"^(\d+),",
        {0: shorter, 1: (r"^((?:[^,]*,){3})[^,]*", "$1never")},
    )
    car_lines = _damaged(
        cars.car_lines(spark, sf_dir), r"e(\d+)", {0: shorter, 1: (r"[^,;\s]*$", "never")}
    )
    rejects = {
        "ride": records.parse_rides(ride_lines)[1],
        "fare": records.parse_fares(fare_lines)[1],
        "car": records.parse_car_events(car_lines)[1],
    }
    found = [
        rows.groupBy(F.lit(kind).alias("kind"), "reason").agg(
            F.count(F.lit(1)).alias("n"), F.sum("number").alias("total")
        )
        for kind, rows in rejects.items()
    ]
    return found[0].unionByName(found[1]).unionByName(found[2])


@query(
    f"""SELECT c_custkey, {_cell_sql(_lon_sql("c_custkey"), _lat_sql("c_custkey"))} AS cell
        FROM customer"""
)
def geo_cell(spark, sf_dir):
    cell = grid_cell(_lon("c_custkey"), _lat("c_custkey"))
    return load(spark, sf_dir, "customer").select("c_custkey", cell.alias("cell"))


def fares(spark, sf_dir):
    """One fare per order."""
    return load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("ride_id"),
        F.col("o_custkey").alias("taxi_id"),
        (F.col("o_custkey") % 50).alias("driver_id"),
        F.col("o_orderdate").cast("timestamp").alias("start_time"),
        F.when(F.col("o_orderstatus") == "O", "CSH").otherwise("CRD").alias("payment_type"),
        ((F.col("o_orderkey") % 1000) / 100).cast("float").alias("tip"),
        ((F.col("o_custkey") % 300) / 100).cast("float").alias("tolls"),
        ((cents("o_totalprice") % 100_000) / 100).cast("float").alias("total_fare"),
    )


_FARES = """(SELECT o_orderkey AS ride_id, o_custkey AS taxi_id, o_custkey % 50 AS driver_id,
    o_orderdate AS start_time, CASE WHEN o_orderstatus = 'O' THEN 'CSH' ELSE 'CRD' END AS payment_type,
    CAST((o_orderkey % 1000) / 100.0 AS FLOAT) AS tip, CAST((o_custkey % 300) / 100.0 AS FLOAT) AS tolls,
    CAST((CAST(round(o_totalprice * 100) AS BIGINT) % 100000) / 100.0 AS FLOAT) AS total_fare
    FROM orders)"""


@query(
    f"""SELECT ride_id, taxi_id, driver_id, start_time, payment_type,
        round(CAST(tip AS DOUBLE), 2) AS tip, round(CAST(tolls AS DOUBLE), 2) AS tolls,
        round(CAST(total_fare AS DOUBLE), 2) AS total_fare FROM {_FARES}"""
)
def parse_fares(spark, sf_dir):
    """Fares to lines and back; lines may leave the tolls empty for zero."""
    lines = records.format_fares(fares(spark, sf_dir))
    lines = lines.select(F.regexp_replace("value", r",0\.0,([^,]*)$", ",,$1").alias("value"))
    good, _ = records.parse_fares(lines)
    return good.withColumns(
        {
            "start_time": F.col("start_time").cast("timestamp_ntz"),
            "tip": F.round(F.col("tip").cast("double"), 2),
            "tolls": F.round(F.col("tolls").cast("double"), 2),
            "total_fare": F.round(F.col("total_fare").cast("double"), 2),
        }
    )


@query(
    f"""SELECT 'fare' AS kind, concat_ws(',', ride_id, taxi_id, driver_id,
            strftime(start_time, '%Y-%m-%d %H:%M:%S'), payment_type, tip, tolls, total_fare) AS line
        FROM {_FARES}
        UNION ALL
        SELECT 'pair', '(' || event_type || ',' || event_id || ')' FROM events
        UNION ALL
        SELECT 'segment', concat_ws(', ', user_id, epoch_us(start_time) // 1000,
            length || ' events', max_speed || ' kph', manner) FROM ({SQL["stop_segments"]})"""
)
def format_records(spark, sf_dir):
    segments = cars.stop_segments(spark, sf_dir)
    texts = {
        "fare": records.format_fares(fares(spark, sf_dir), "line"),
        "pair": records.format_pairs(events(spark, sf_dir), "event_type", "event_id", "line"),
        "segment": records.format_segments(segments, "user_id", "start_time", "line"),
    }
    kinds = [text.select(F.lit(kind).alias("kind"), "line") for kind, text in texts.items()]
    return kinds[0].unionByName(kinds[1]).unionByName(kinds[2])


@query("SELECT c_mktsegment AS key, CAST(c_custkey AS INTEGER) AS number FROM customer")
def parse_pairs(spark, sf_dir):
    lines = load(spark, sf_dir, "customer").select(
        F.concat_ws(",", "c_mktsegment", "c_custkey").alias("value")
    )
    good, _ = records.parse_pairs(lines, T.IntegerType())
    return good


@query("SELECT CAST(user_id AS VARCHAR) AS key, epoch_us(ts) // 1000 AS number FROM events")
def src_gzip_text(spark, sf_dir):
    """Pair lines through gzip files: written by Spark, read and parsed again."""
    folder = work_folder(spark, "gzip")
    source = load(spark, sf_dir, "events")
    epoch_ms = F.unix_millis(F.col("ts").cast("timestamp"))
    pairs = source.select(F.concat_ws(", ", "user_id", epoch_ms.cast("string")).alias("value"))
    pairs.write.text(folder, compression="gzip")
    good, _ = records.parse_pairs(read_lines(spark, "text", folder), T.LongType())
    return good


@query(
    """SELECT user_id, count(*) AS n FROM events WHERE event_type = 'click' GROUP BY user_id"""
)
def ride_count(spark, sf_dir):
    clicks = events(spark, sf_dir).withColumn("is_start", F.col("event_type") == "click")
    return ops.ride_count(clicks, "user_id")


def _trips(spark, sf_dir):
    """Order lines as trips from order date to ship date."""
    lines = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", (F.col("l_suppkey") % 250).alias("cell")
    )
    orders = load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"
    )
    both = lookup_join(lines, orders, ["l_orderkey"])
    good, _ = ops.trip_minutes(both, "o_orderdate", "l_shipdate", None)
    return good.select("l_orderkey", "l_linenumber", "cell", "minutes")


_TRIPS = """(SELECT l_orderkey, l_linenumber, l_suppkey % 250 AS cell,
    (epoch_us(l_shipdate) - epoch_us(o_orderdate)) // 60000000 AS minutes
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate >= o_orderdate)"""


@query(f"SELECT cell, max(minutes) AS minutes FROM {_TRIPS} GROUP BY cell")
def longest_trip_by_cell(spark, sf_dir):
    return ops.longest_trip(_trips(spark, sf_dir), "cell")


@query(
    f"""SELECT l_orderkey, l_linenumber, cell, minutes, max(minutes) OVER (PARTITION BY cell
        ORDER BY l_orderkey, l_linenumber, minutes ROWS UNBOUNDED PRECEDING) AS longest
        FROM {_TRIPS}"""
)
def longest_trip_by_cell_running(spark, sf_dir):
    order = ["l_orderkey", "l_linenumber", "minutes"]
    return ops.longest_trip_running(_trips(spark, sf_dir), "cell", order)


def trip_sides(lineitem, orders, times: bool = False):
    """Fares from order lines and started rides from open orders, on request with their times."""
    fare_ts = [F.col("l_shipdate").cast("timestamp").alias("fare_ts")] if times else []
    ride_ts = [F.col("o_orderdate").cast("timestamp").alias("ride_ts")] if times else []
    fares_ = lineitem.select(
        "l_orderkey", "l_linenumber", cents("l_extendedprice").alias("fare"), *fare_ts
    )
    started = orders.filter(F.col("o_orderstatus") == "O")
    return fares_, started.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", *ride_ts)


@query(
    """SELECT l_orderkey, l_linenumber, o_custkey, CAST(round(l_extendedprice * 100) AS BIGINT) AS fare
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'O'"""
)
def join_rides_fares(spark, sf_dir):
    """Open orders stand for started rides, their lines for fares."""
    fare_rows, started = trip_sides(load(spark, sf_dir, "lineitem"), load(spark, sf_dir, "orders"))
    return pairing.join_rides_fares(fare_rows, started, ["l_orderkey"])
