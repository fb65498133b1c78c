"""Per-key operators in arrival order: running folds, count windows, rules, pairs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tideline.operators import control, pairing, triggers
from tideline.operators import count_windows as cw
from tideline.operators.accumulators import Average, Quantile, accumulate
from tideline.plans.registry import EVENTS_SQL, events, query

_BY_USER = "PARTITION BY user_id ORDER BY event_id"
_NUMBERED = f"(SELECT *, row_number() OVER ({_BY_USER}) AS rn FROM {EVENTS_SQL})"
_ORDER = ["event_id"]


@query(
    f"""SELECT event_id, user_id, CAST(sum(cents) OVER ({_BY_USER} ROWS UNBOUNDED PRECEDING)
        AS BIGINT) AS total FROM {EVENTS_SQL}"""
)
def running_sum(spark, sf_dir):
    rows = cw.running_sum(events(spark, sf_dir), "user_id", _ORDER, "cents")
    return rows.select("event_id", "user_id", "total")


@query(
    f"""SELECT event_id, user_id, 'Contains: ' || array_to_string(list(cents) OVER
        ({_BY_USER} ROWS UNBOUNDED PRECEDING), ' and ') AS text FROM {EVENTS_SQL}"""
)
def running_text(spark, sf_dir):
    rows = events(spark, sf_dir).select("event_id", "user_id", "cents")
    return cw.running_text(rows, "user_id", _ORDER, "cents").drop("cents")


@query(
    f"""SELECT user_id, rn, total FROM (SELECT user_id, rn, CAST(sum(cents) OVER
        ({_BY_USER} ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total FROM {_NUMBERED}) WHERE rn % 3 = 0"""
)
def count_window_cumulative(spark, sf_dir):
    return cw.count_window_cumulative(events(spark, sf_dir), "user_id", _ORDER, "cents", 3)


_BLOCKS = f"""(SELECT user_id, (rn - 1) // 3 + 1 AS block, CAST(sum(cents) AS BIGINT) AS total,
    round(avg(cents), 4) AS average FROM {_NUMBERED} GROUP BY user_id, block HAVING count(*) = 3)"""


@query(f"SELECT user_id, block, total FROM {_BLOCKS}")
def count_window_tumbling(spark, sf_dir):
    blocks = cw.count_window_tumbling(events(spark, sf_dir), "user_id", _ORDER, "cents", 3)
    return blocks.drop("average")


@query(
    f"""SELECT user_id, rn, total FROM (SELECT user_id, rn, CAST(sum(cents) OVER
        ({_BY_USER} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS BIGINT) AS total
        FROM {_NUMBERED}) WHERE rn % 2 = 0"""
)
def count_window_sliding(spark, sf_dir):
    return cw.count_window_sliding(events(spark, sf_dir), "user_id", _ORDER, "cents", 3, 2)


@query(f"SELECT user_id, block, average FROM {_BLOCKS}")
def count_avg(spark, sf_dir):
    averages = cw.count_average(events(spark, sf_dir), "user_id", _ORDER, "cents")
    return averages.withColumn("average", F.round("average", 4))


@query(
    f"""SELECT (rn - 1) // 20 AS batch_no, count(*) AS n, min(event_id) AS first_id,
            max(event_id) AS last_id, CAST(sum(cents) AS BIGINT) AS total
        FROM (SELECT *, row_number() OVER (ORDER BY event_id) AS rn FROM {EVENTS_SQL})
        GROUP BY batch_no"""
)
def sink_batches(spark, sf_dir):
    batches = cw.sink_batches(events(spark, sf_dir), _ORDER, 20)
    return batches.groupBy("batch_no").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("event_id").alias("first_id"),
        F.max("event_id").alias("last_id"),
        F.sum("cents").alias("total"),
    )


@query(
    f"""WITH c AS (SELECT event_id AS at, cents AS rule FROM {EVENTS_SQL} WHERE event_type = 'signup'),
        d AS (SELECT event_id, cents FROM {EVENTS_SQL} WHERE event_type <> 'signup')
        SELECT event_id, cents, coalesce(rule, -1) AS rule FROM d ASOF LEFT JOIN c ON d.event_id >= c.at
        WHERE rule IS NULL OR cents <= rule"""
)
def dynamic_rule_filter(spark, sf_dir):
    """A signup sets the largest amount that may pass."""
    rows = control.dynamic_rule_filter(
        events(spark, sf_dir).select("event_id", "event_type", "cents"),
        F.col("event_type") == "signup",
        F.col("cents"),
        F.col("cents"),
        _ORDER,
    )
    return rows.select("event_id", "cents", F.coalesce("rule", F.lit(-1)).alias("rule"))


@query(
    """SELECT d.event_id, d.grp, d.cents, coalesce(r.cents, -1) AS rule
        FROM (SELECT event_id, user_id % 64 AS grp, CAST(round(value * 100) AS BIGINT) AS cents
              FROM events WHERE event_type IS DISTINCT FROM 'signup') d
        ASOF LEFT JOIN (SELECT event_id, user_id % 64 AS grp, CAST(round(value * 100) AS BIGINT) AS cents
              FROM events WHERE event_type = 'signup') r
        ON d.grp = r.grp AND d.event_id > r.event_id
        WHERE r.cents IS NULL OR d.cents <= r.cents"""
)
def rules_asof(spark, sf_dir):
    """A signup sets the largest amount that may pass in its group of users."""
    rows = events(spark, sf_dir).select(
        "event_id", (F.col("user_id") % 64).alias("grp"), "event_type", "cents"
    )
    ruled = control.rules_asof(
        rows, F.col("event_type") == "signup", "grp", F.col("cents"), F.col("cents"), _ORDER
    )
    return ruled.select("event_id", "grp", "cents", F.coalesce("rule", F.lit(-1)).alias("rule"))


# One step per row of a key: the saved row of either side is kept in (l, r).
@query(
    """WITH RECURSIVE base AS (SELECT user_id, event_id, event_type = 'view' AS is_left,
            row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn
            FROM events WHERE event_type IN ('view', 'purchase')),
        walk(user_id, rn, l, r, event_id, left_event_id, right_event_id) AS (
            SELECT DISTINCT user_id, CAST(0 AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT),
                CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT) FROM base
            UNION ALL
            SELECT b.user_id, b.rn,
                CASE WHEN b.is_left AND w.r IS NULL THEN b.event_id
                    WHEN NOT b.is_left AND w.l IS NOT NULL THEN NULL ELSE w.l END,
                CASE WHEN NOT b.is_left AND w.l IS NULL THEN b.event_id
                    WHEN b.is_left AND w.r IS NOT NULL THEN NULL ELSE w.r END,
                b.event_id,
                CASE WHEN b.is_left AND w.r IS NOT NULL THEN b.event_id
                    WHEN NOT b.is_left AND w.l IS NOT NULL THEN w.l END,
                CASE WHEN b.is_left AND w.r IS NOT NULL THEN w.r
                    WHEN NOT b.is_left AND w.l IS NOT NULL THEN b.event_id END
            FROM walk w JOIN base b ON b.user_id = w.user_id AND b.rn = w.rn + 1)
        SELECT user_id, event_id, left_event_id, right_event_id FROM walk
        WHERE left_event_id IS NOT NULL"""
)
def join_slots(spark, sf_dir):
    """Views pair with purchases of the same user, one saved row per side."""
    sides = events(spark, sf_dir).filter(F.col("event_type").isin("view", "purchase"))
    rows = sides.select(
        "user_id",
        F.col("event_id").alias("seq"),
        (F.col("event_type") == "view").alias("is_left"),
        "event_id",
    )
    pairs = pairing.pair_slots(rows, "user_id", "seq", "is_left", "event_id")
    return pairs.withColumnRenamed("seq", "event_id")


@query(f"SELECT user_id, CAST(sum(cents) AS DOUBLE) / count(cents) AS average FROM {EVENTS_SQL} GROUP BY user_id")
def accumulated_average(spark, sf_dir):
    """A user's own average, in four steps."""
    rows = events(spark, sf_dir).select("user_id", "cents")
    return accumulate(rows, ["user_id"], "cents", Average(), "average")


_PLACE = "(cents >> greatest(0, length(bin(cents)) - 6)) << greatest(0, length(bin(cents)) - 6)"


@query(
    f"""WITH p AS (SELECT event_type, {_PLACE} AS place, count(*) AS n FROM {EVENTS_SQL}
            WHERE cents IS NOT NULL GROUP BY ALL),
        r AS (SELECT event_type, place, sum(n) OVER (PARTITION BY event_type ORDER BY place) AS seen,
            sum(n) OVER (PARTITION BY event_type) AS total FROM p)
        SELECT event_type, CAST(min(place) AS BIGINT) AS median FROM r WHERE seen >= 0.5 * total
        GROUP BY event_type"""
)
def accumulated_median(spark, sf_dir):
    """A sketch of the amounts of each of a few keys: each key has a large part of the rows."""
    rows = events(spark, sf_dir).select("event_type", "cents")
    return accumulate(rows, ["event_type"], "cents", Quantile(0.5), "median")


@query(
    f"""WITH g AS (SELECT user_id, event_id, cents, event_type = 'signup' AS stop, count(*) FILTER
            (event_type = 'signup') OVER ({_BY_USER} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
            AS stops FROM {EVENTS_SQL}),
        p AS (SELECT *, (row_number() OVER (PARTITION BY user_id, stops ORDER BY event_id) - 1) // 4
            AS pane FROM g)
        SELECT user_id, max(event_id) AS last_id, count(*) AS n, CAST(sum(cents) AS BIGINT) AS total
        FROM p GROUP BY user_id, stops, pane HAVING count(*) = 4 OR bool_or(stop)"""
)
def trigger_count_or_stop(spark, sf_dir):
    """A user's window closes with its fourth event, or with a signup."""
    rows = events(spark, sf_dir).select("user_id", "event_id", "event_type", "cents")
    stop = (F.col("event_type") == "signup").cast("int")
    found = triggers.windows(rows, ["user_id"], _ORDER, stop, triggers.count_or_stop(4))
    windows = found.groupBy("user_id", "window_no").agg(
        F.max("event_id").alias("last_id"),
        F.count(F.lit(1)).alias("n"),
        F.sum("cents").alias("total"),
        F.max("closes").alias("closed"),
    )
    return windows.where("closed").select("user_id", "last_id", "n", "total")
