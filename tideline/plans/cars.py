"""Connected cars, made from the events: text form, segments, late rows, sorting."""

from __future__ import annotations

from pyspark.sql import functions as F

from tideline.functions.time import HOUR
from tideline.operators import late, segments
from tideline.plans.registry import ARRIVAL, ARRIVALS_SQL, EVENTS_SQL, arrivals, events, query
from tideline.sources import records


def car_lines(spark, sf_dir):
    """Car events as lines of 23 tokens between commas and semicolons."""
    text = lambda c: c.cast("string")
    used = {
        0: text(F.col("user_id")),
        1: F.concat(F.lit("e"), text(F.col("event_id"))),
        7: text((F.col("cents") % 700) / 100),
        9: F.when(F.col("event_type") == "error", "").otherwise(text(F.col("cents") / 100)),
        12: text((F.col("cents") % 1000) / 100),
        19: text((F.col("event_id") % 90) / 4),
        20: text((F.col("user_id") % 90) / 8),
        21: text((F.col("user_id") % 45) / 8),
        22: F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'+0000'"),
    }
    parts = []
    for i in range(23):
        parts += [used.get(i, F.lit("x")), F.lit("; " if i % 3 else ",")]
    return events(spark, sf_dir).select(F.concat(*parts[:-1]).alias("value"))


_REAL = ["consumption", "speed", "throttle", "engineload", "longitude", "latitude"]


@query(
    f"""SELECT CAST(user_id AS VARCHAR) AS car_id, 'e' || event_id AS id,
        round((cents % 700) / 100.0, 2) AS consumption,
        CASE WHEN event_type = 'error' THEN 0.0 ELSE round(cents / 100.0, 2) END AS speed,
        round((cents % 1000) / 100.0, 2) AS throttle, round((event_id % 90) / 4.0, 2) AS engineload,
        round((user_id % 90) / 8.0, 2) AS longitude, round((user_id % 45) / 8.0, 2) AS latitude,
        date_trunc('second', ts) AS ts FROM {EVENTS_SQL}"""
)
def parse_car_events(spark, sf_dir):
    good, _ = records.parse_car_events(car_lines(spark, sf_dir))
    changed = {c: F.round(F.round(F.col(c).cast("double"), 3), 2) for c in _REAL}
    return good.withColumns(changed | {"ts": F.col("ts").cast("timestamp_ntz")})


@query(
    f"""WITH s AS (SELECT *, min(CASE WHEN event_type = 'error' THEN ts END) OVER
            (PARTITION BY user_id ORDER BY ts RANGE BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
            AS stop_time, (cents % 1000) / 100.0 AS throttle FROM {EVENTS_SQL})
        SELECT user_id, min(ts) AS start_time, stop_time, count(*) AS length,
            max(value) AS max_speed, round(stddev_pop(throttle), 4) AS erraticness,
            CASE CAST(floor(CAST(CAST(stddev_pop(throttle) AS FLOAT) AS DOUBLE) / 2.5) AS INTEGER)
                WHEN 0 THEN 'calm' WHEN 1 THEN 'busy' ELSE 'crazy' END AS manner
        FROM s WHERE event_type <> 'error' AND stop_time IS NOT NULL GROUP BY user_id, stop_time"""
)
def stop_segments(spark, sf_dir):
    cars = events(spark, sf_dir).withColumn("throttle", (F.col("cents") % 1000) / 100)
    stop = F.col("event_type") == "error"
    found = segments.stop_segments(cars, "user_id", "ts", "value", "throttle", stop)
    return found.withColumn("erraticness", F.round("erraticness", 4))


def _late_sql(marker: str, lateness: str = "INTERVAL 0 HOUR") -> str:
    return f"""(WITH m AS (SELECT *, max({marker}) OVER (ORDER BY seq, event_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 1 HOUR AS mark,
            date_trunc('hour', ts) AS window_start FROM {ARRIVALS_SQL})
        SELECT event_id, user_id, ts, seq, window_start, window_start + INTERVAL 1 HOUR AS window_end,
            coalesce(window_start + INTERVAL 1 HOUR - INTERVAL 1 MILLISECOND + {lateness} <= mark, false)
            AS late FROM m)"""


_COLUMNS = "event_id, window_start, window_end, late"


@query(f"SELECT {_COLUMNS} FROM {_late_sql('ts')}")
def late_split(spark, sf_dir):
    rows = late.late_rows(arrivals(spark, sf_dir), "ts", ARRIVAL, HOUR, HOUR)
    return rows.select("event_id", "window_start", "window_end", "late")


_SIGNUP = "CASE WHEN event_type = 'signup' THEN ts END"


@query(f"SELECT {_COLUMNS} FROM {_late_sql(_SIGNUP, 'INTERVAL 10 MINUTE')}")
def late_split_marker(spark, sf_dir):
    """Only signups move the watermark, and ten minutes of lateness are allowed."""
    marker = F.col("event_type") == "signup"
    rows = late.late_rows(
        arrivals(spark, sf_dir), "ts", ARRIVAL, HOUR, HOUR, lateness_micros=HOUR // 6, marker=marker
    )
    return rows.select("event_id", "window_start", "window_end", "late")


@query(
    f"""SELECT user_id, window_start, window_end, count(*) AS n,
            string_agg('(' || user_id || ',' || epoch_us(ts) // 1000 || ')|' || strftime(ts, '%H:%M:%S'),
                ', ' ORDER BY seq, event_id) AS elements
        FROM {_late_sql("ts")} WHERE NOT late GROUP BY user_id, window_start, window_end"""
)
def tumbling_event_time(spark, sf_dir):
    """Elements per user and window, without the late rows."""
    on_time, _ = late.late_split(arrivals(spark, sf_dir), "ts", ARRIVAL, HOUR, HOUR)
    return late.window_elements(on_time, "user_id", "ts", ARRIVAL)


@query(
    f"""SELECT user_id, event_id, window_start, window_end, row_number() OVER (PARTITION BY user_id,
            window_start ORDER BY seq, event_id) AS pos FROM {_late_sql("ts")} WHERE NOT late"""
)
def window_positions(spark, sf_dir):
    """The same, one row per element."""
    on_time, _ = late.late_split(arrivals(spark, sf_dir), "ts", ARRIVAL, HOUR, HOUR)
    rows = late.window_element_rows(on_time, "user_id", "ts", ARRIVAL)
    return rows.select("user_id", "event_id", "window_start", "window_end", "pos")


_SORTER = f"""(SELECT *, coalesce(ts <= max(ts) OVER (ORDER BY seq, event_id ROWS BETWEEN
    UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 1 HOUR, false) AS late FROM {ARRIVALS_SQL})"""


@query(f"SELECT user_id, ts, event_id FROM {_SORTER} WHERE NOT late")
def car_sort(spark, sf_dir):
    rows = late.car_sort(arrivals(spark, sf_dir), "user_id", "ts", ARRIVAL, HOUR)
    return rows.select("user_id", "ts", "event_id")


@query(f"SELECT event_id FROM {_SORTER} WHERE late")
def car_late_ids(spark, sf_dir):
    return late.car_late_ids(arrivals(spark, sf_dir), "event_id", "ts", ARRIVAL, HOUR)
