"""Time windows and sessions over the events; hours stand for seconds."""

from __future__ import annotations

from pyspark.sql import functions as F

from tideline.functions.time import HOUR
from tideline.operators import sessions as session_ops
from tideline.operators import time_windows as tw
from tideline.plans.registry import EVENTS_SQL, cents, events, load, query
from tideline.sources.lines import with_arrival

_HOURLY = f"(SELECT *, date_trunc('hour', ts) AS window_start FROM {EVENTS_SQL})"
_END = "window_start + INTERVAL 1 HOUR AS window_end"
_SLIDING = f"""(SELECT *, h - to_hours(CAST(k AS INTEGER)) AS window_start,
    h - to_hours(CAST(k AS INTEGER)) + INTERVAL 2 HOUR AS window_end
    FROM (SELECT *, date_trunc('hour', ts) AS h FROM events), range(2) AS r(k))"""


@query(
    f"""SELECT window_start, {_END}, user_id, CAST(sum(cents) AS BIGINT) AS total
        FROM {_HOURLY} GROUP BY window_start, user_id"""
)
def window_reduce_sum(spark, sf_dir):
    return tw.window_sum(events(spark, sf_dir), "ts", "user_id", "cents", "1 hour")


@query(
    f"""SELECT window_start, {_END}, user_id, round(avg(cents), 4) AS average
        FROM {_HOURLY} GROUP BY window_start, user_id"""
)
def window_avg(spark, sf_dir):
    averages = tw.window_average(events(spark, sf_dir), "ts", "user_id", "cents", "1 hour")
    return averages.withColumn("average", F.round("average", 4))


@query(
    f"""SELECT window_start, window_end, event_type, n, 'Window: [' ||
            strftime(window_start, '%Y-%m-%d %H:%M:%S') || ', ' ||
            strftime(window_end, '%Y-%m-%d %H:%M:%S') || '), key: ' || event_type ||
            ', count: ' || n AS report
        FROM (SELECT window_start, {_END}, event_type, count(*) AS n
            FROM {_HOURLY} GROUP BY window_start, event_type)"""
)
def window_count(spark, sf_dir):
    return tw.window_count_report(events(spark, sf_dir), "ts", "event_type", "1 hour")


@query(
    f"""SELECT window_start, window_end, event_type, count(*) AS n
        FROM {_SLIDING} GROUP BY window_start, window_end, event_type"""
)
def sliding_word_count(spark, sf_dir):
    return tw.window_count(events(spark, sf_dir), "ts", "2 hours", "1 hour", ["event_type"])


@query(
    """SELECT window_start, window_start + INTERVAL 3 HOUR AS window_end, count(*) AS n
        FROM (SELECT time_bucket(INTERVAL 3 HOUR, ts, TIMESTAMP '1970-01-01') AS window_start FROM events)
        GROUP BY window_start"""
)
def tumbling_all_count(spark, sf_dir):
    return tw.window_count(events(spark, sf_dir), "ts", "3 hours")


@query(
    f"""SELECT window_start, window_end, user_id, count(*) AS n
        FROM {_SLIDING} GROUP BY window_start, window_end, user_id"""
)
def sliding_event_time(spark, sf_dir):
    return tw.window_count(events(spark, sf_dir), "ts", "2 hours", "1 hour", ["user_id"])


_TIPS = f"""(SELECT window_start, {_END}, user_id, CAST(sum(cents) AS BIGINT) AS tips
    FROM {_HOURLY} GROUP BY window_start, user_id)"""


@query(f"SELECT window_start, window_end, user_id, tips FROM {_TIPS}")
def hourly_tips(spark, sf_dir):
    return tw.hourly_tips(events(spark, sf_dir), "ts", "user_id", "cents")


@query(
    f"""SELECT window_start, window_end, user_id, tips FROM (SELECT *, row_number() OVER
            (PARTITION BY window_start ORDER BY tips DESC, user_id) AS place FROM {_TIPS})
        WHERE place = 1"""
)
def hourly_top_driver(spark, sf_dir):
    return tw.hourly_top_driver(events(spark, sf_dir), "ts", "user_id", "cents")


def _sessions_sql(gap: str, columns: str) -> str:
    """Sessions in SQL: a row opens one if it lies beyond all earlier rows' ts + gap."""
    return f"""WITH g AS (SELECT *, {gap} AS gap FROM {EVENTS_SQL}),
        r AS (SELECT *, max(ts + gap) OVER (PARTITION BY user_id ORDER BY ts, event_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached FROM g),
        s AS (SELECT *, sum(CASE WHEN reached IS NULL OR ts > reached THEN 1 ELSE 0 END)
            OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS no FROM r)
        SELECT user_id, min(ts) AS session_start, max(ts + gap) AS session_end,
            count(*) AS length, {columns} FROM s GROUP BY user_id, no"""


_MANNER = """CASE CAST(floor(CAST(CAST(stddev_pop((cents % 1000) / 100.0) AS FLOAT) AS DOUBLE) / 2.5) AS INTEGER)
    WHEN 0 THEN 'calm' WHEN 1 THEN 'busy' ELSE 'crazy' END"""


@query(
    _sessions_sql(
        "INTERVAL 6 HOUR",
        f"""max(value) AS max_speed,
            round(stddev_pop((cents % 1000) / 100.0), 4) AS erraticness, {_MANNER} AS manner""",
    )
)
def driving_sessions(spark, sf_dir):
    cars = events(spark, sf_dir).withColumn("throttle", (F.col("cents") % 1000) / 100)
    found = session_ops.driving_sessions(cars, "user_id", "ts", "value", "throttle", 6 * HOUR)
    return found.withColumn("erraticness", F.round("erraticness", 4))


@query(
    _sessions_sql(
        """CASE event_type WHEN 'view' THEN INTERVAL 4 HOUR WHEN 'purchase' THEN INTERVAL 8 HOUR
            ELSE INTERVAL 2 HOUR END""",
        "CAST(sum(cents) AS BIGINT) AS total",
    )
)
def session_dynamic_gap(spark, sf_dir):
    kind = F.col("event_type")
    hours = F.when(kind == "view", 4).when(kind == "purchase", 8).otherwise(2)
    gap = hours.cast("long") * HOUR
    return session_ops.sessions(events(spark, sf_dir), "user_id", "ts", gap, total=F.col("cents"))


@query(_sessions_sql("INTERVAL 2 HOUR", "CAST(sum(cents) AS BIGINT) AS total"))
def session_fixed_gap(spark, sf_dir):
    gap = F.lit(2 * HOUR).cast("long")
    return session_ops.sessions(events(spark, sf_dir), "user_id", "ts", gap, total=F.col("cents"))


@query()
def arrival_window_count(spark, sf_dir):
    """Events and their amounts per type and minute of arrival, that is, of their file's writing. (The
    tables do not hold that time, so there is no SQL form.)"""
    rows = with_arrival(load(spark, sf_dir, "events")).withColumn("cents", cents("value"))
    return tw.time_window(
        rows, "arrived", "1 minute", keys=["event_type"], n=F.count("event_id"), total=F.sum("cents")
    )
