import random
from statistics import pstdev

import pytest
from conftest import rows_of
from pyspark.sql import functions as F
from test_records import CAR, car_line, lines

from tideline.functions.time import SECOND
from tideline.operators import late, segments, sessions, time_windows
from tideline.sources import records


def at_seconds(spark, rows, schema="key string, t long"):
    source = spark.createDataFrame(rows, schema)
    return source.withColumn("ts", F.timestamp_micros(F.col("t") * SECOND))


def cars(spark):
    text = "\n".join(car_line(*event) for event in CAR)
    good, _ = records.parse_car_events(lines(spark, text))
    seq = spark.createDataFrame([(e[1], e[0]) for e in CAR], "id string, seq long")
    return good.join(seq, "id")


def test_sliding_windows(spark):
    source = at_seconds(spark, [("a", 13), ("a", 13), ("a", 16)])
    counts = time_windows.window_count(source, "ts", "10 seconds", "5 seconds", ["key"])
    assert rows_of(counts.select(F.unix_timestamp("window_start"), "n")) == [(10, 3), (15, 1), (5, 2)]


def test_tumbling_measures(spark):
    source = at_seconds(spark, [("a", 0), ("a", 4), ("b", 4), ("a", 5)]).withColumn("v", F.col("t") + 1)
    total = time_windows.window_sum(source, "ts", "key", "v", "5 seconds")
    assert rows_of(total, "key", "total") == [("a", 6), ("a", 6), ("b", 5)]
    average = time_windows.window_average(source, "ts", "key", "v", "5 seconds")
    assert rows_of(average, "key", "average") == [("a", 3.0), ("a", 6.0), ("b", 5.0)]
    report = time_windows.window_count_report(source, "ts", "key", "5 seconds")
    first = "Window: [1970-01-01 00:00:00, 1970-01-01 00:00:05), key: a, count: 2"
    assert first in [row.report for row in report.collect()]


@pytest.mark.parametrize("hot_rows", [1 << 20, 2])
def test_session_gap_per_row(spark, small_chunks, hot_rows):
    rows = [("this", t) for t in (0, 10, 21)] + [("is", t) for t in (0, 19)]
    rows += [("example", t) for t in (0, 4, 10)]
    gap = F.when(F.col("key") == "this", 10).when(F.col("key") == "is", 20).otherwise(5)
    found = sessions.sessions(
        at_seconds(spark, rows), "key", "ts", gap.cast("long") * SECOND, hot_rows=hot_rows
    )
    expected = [("this", 2), ("this", 1), ("is", 2), ("example", 2), ("example", 1)]
    assert rows_of(found, "key", "length") == sorted(expected, key=repr)


@pytest.mark.parametrize("hot_rows", [1 << 20, 2])
def test_driving_sessions(spark, small_chunks, hot_rows):
    found = sessions.driving_sessions(
        cars(spark), "car_id", "ts", "speed", "throttle", 15 * SECOND, hot_rows
    )
    assert rows_of(found, "length", "max_speed") == [(3, 50.0), (6, 40.0)]
    long = found.filter("length = 6").first()
    assert abs(long.erraticness - pstdev([10, 14, 12, 0, 10, 10])) < 1e-9


def brute_sessions(rows, gap_of):
    found = {}
    for key in {r[0] for r in rows}:
        reach = None
        for _, t, v in sorted(r for r in rows if r[0] == key):
            if reach is None or t > reach:
                found.setdefault(key, []).append([t, None, 0, []])
                reach = t
            reach = max(reach, t + gap_of(v))
            part = found[key][-1]
            part[1], part[2] = reach, part[2] + 1
            part[3].append(v)
    return sorted(
        (k, s, e, n, max(vs), sum(vs), round(pstdev(vs), 6)) for k, parts in found.items() for s, e, n, vs in parts
    )


@pytest.mark.parametrize("seed", [1, 2])
def test_sessions_of_hot_keys_match_brute_force(spark, small_chunks, seed):
    rng = random.Random(seed)
    # One key holds most rows, and many of its rows share a moment.
    rows = [("hot", rng.randrange(120) * 3, rng.randrange(9)) for _ in range(150)]
    rows += [(f"k{i % 20}", rng.randrange(100), rng.randrange(9)) for i in range(60)]
    source = at_seconds(spark, rows, "key string, t long, v long")
    micro = source.withColumn("ts", F.timestamp_micros("t"))
    found = sessions.sessions(
        micro, "key", "ts", F.col("v"), peak=F.col("v"), level=F.col("v"), total=F.col("v"), hot_rows=10
    )
    flat = found.select(
        "key",
        F.unix_micros("session_start").alias("s"),
        F.unix_micros("session_end").alias("e"),
        "length",
        "max_peak",
        "total",
        F.round("erraticness", 6).alias("d"),
    )
    assert sorted(tuple(r) for r in flat.collect()) == brute_sessions(rows, lambda v: v)


@pytest.mark.parametrize("hot_rows", [1 << 20, 2])
def test_stop_segments(spark, small_chunks, hot_rows):
    found = segments.stop_segments(cars(spark), "car_id", "ts", "speed", "throttle", hot_rows=hot_rows)
    flat = found.select(
        F.unix_timestamp("start_time") % 86400, "length", "max_speed", F.round("erraticness", 4), "manner"
    )
    assert rows_of(flat) == [(0, 3, 30.0, 1.633, "calm"), (21, 3, 50.0, 4.714, "busy")]
    lines_ = records.format_segments(found, "car_id", "start_time").collect()
    assert "c1, 1485129600000, 3 events, 30.0 kph, calm" in [row.value for row in lines_]


@pytest.mark.parametrize("seed", [3, 4])
def test_segments_of_hot_cars_match_brute_force(spark, small_chunks, seed):
    rng = random.Random(seed)
    rows = [("hot", rng.randrange(60), rng.choice([0, 0, 5, 6, 7, 8])) for _ in range(150)]
    rows += [(f"k{i % 9}", rng.randrange(60), rng.choice([0, 3, 4])) for i in range(60)]
    expected, members = [], {}
    for key, t, speed in rows:
        stops = [s for k, s, v in rows if k == key and v == 0 and s >= t]
        if speed and stops:
            members.setdefault((key, min(stops)), []).append((t, speed))
    for (key, stop), part in members.items():
        speeds = [s for _, s in part]
        expected.append((key, min(t for t, _ in part), stop, len(part), max(speeds), round(pstdev(speeds), 6)))
    source = at_seconds(spark, rows, "key string, t long, v long").withColumn("ts", F.timestamp_micros("t"))
    found = segments.stop_segments(source, "key", "ts", "v", "v", hot_rows=10)
    flat = found.select(
        "key",
        F.unix_micros("start_time").alias("a"),
        F.unix_micros("stop_time").alias("b"),
        "length",
        "max_speed",
        F.round("erraticness", 6).alias("d"),
    )
    assert sorted(tuple(r) for r in flat.collect()) == sorted(expected)


def test_sorter(spark):
    order = ["seq"]
    ids = late.car_late_ids(cars(spark), "id", "ts", order, 30 * SECOND)
    assert rows_of(ids) == [("e7",)]
    ordered = late.car_sort(cars(spark), "car_id", "ts", order, 30 * SECOND).collect()
    assert [row.id for row in ordered] == ["e1", "e2", "e3", "e4", "e5", "e6", "e8", "e9"]


@pytest.mark.parametrize(("lateness", "expected"), [(0, [2]), (2, [])])
def test_late_split(spark, small_chunks, lateness, expected):
    rows = [(i, t) for i, t in enumerate([0, 1, 13, 2, 14])]
    source = at_seconds(spark, rows, "seq long, t long").withColumn("key", F.lit("a"))
    on_time, too_late = late.late_split(
        source, "ts", ["seq"], 3 * SECOND, 10 * SECOND, lateness * SECOND
    )
    assert [row.t for row in too_late.collect()] == expected
    assert on_time.count() + too_late.count() == 5
    if expected:
        assert rows_of(late.late_text(too_late, "key", "ts"), "text") == [("late: (a,2000)",)]
        found = late.window_elements(on_time, "key", "ts", ["seq"]).orderBy("window_start").collect()
        assert found[0].elements == "(a,0)|00:00:00, (a,1000)|00:00:01" and found[0].n == 2


def test_late_rows_match_brute_force(spark, small_chunks):
    rng = random.Random(5)
    rows = [(i, i + rng.randrange(-20, 20) + 20) for i in range(120)]
    source = at_seconds(spark, rows, "seq long, t long")
    marker = F.col("t") % 2 == 0
    for chosen in (None, marker):
        found = late.late_rows(source, "ts", ["seq"], 3 * SECOND, 10 * SECOND, marker=chosen)
        top, expected = None, []
        for seq, t in rows:
            end = t - t % 3 + 3
            expected.append((seq, top is not None and end - 0.001 <= top - 10))
            if chosen is None or t % 2 == 0:
                top = t if top is None else max(top, t)
        assert sorted(tuple(r) for r in found.select("seq", "late").collect()) == expected


def test_element_lists_are_whole_and_rows_have_positions(spark, small_chunks):
    source = at_seconds(spark, [(i * 7, 0) for i in range(25)], "seq long, t long")
    on_time, _ = late.late_split(source.withColumn("key", F.lit(1)), "ts", ["seq"], 3 * SECOND, 0)
    whole = late.window_elements(on_time, "key", "ts", ["seq"]).collect()
    assert [(row.n, row.elements.count("|")) for row in whole] == [(25, 25)]
    rows = late.window_element_rows(on_time, "key", "ts", ["seq"], hot_rows=10)
    assert rows_of(rows, "seq", "pos") == sorted(((i * 7, i + 1) for i in range(25)), key=repr)


@pytest.mark.parametrize("hot_rows", [1 << 20, 2])
def test_deviation_of_large_and_missing_values(spark, small_chunks, hot_rows):
    base = 1e9
    rows = [("far", t, base + t % 4) for t in range(40)] + [("none", t, None) for t in range(8)]
    rows += [("some", t, None if t % 2 else base + t) for t in range(20)]
    source = spark.createDataFrame(rows, "key string, t long, v double")
    source = source.withColumn("ts", F.timestamp_seconds("t")).withColumn("one", F.lit(1))
    expected = source.groupBy("key").agg(F.round(F.stddev_pop("v"), 6).alias("d"))
    gap = 5 * SECOND
    found = sessions.driving_sessions(source, "key", "ts", "one", "v", gap, hot_rows=hot_rows)
    assert rows_of(found, "key", F.round("erraticness", 6)) == rows_of(expected)
    assert dict(rows_of(found, "key", "manner"))["none"] is None
    last = source.groupBy("key").agg(F.max("t").alias("t"), F.last("v").alias("v"))
    stops = last.select("key", (F.col("t") + 1).alias("t"), F.lit(base).alias("v")).withColumn("one", F.lit(0))
    driven = source.unionByName(stops.withColumn("ts", F.timestamp_seconds("t")))
    found = segments.stop_segments(driven, "key", "ts", "one", "v", hot_rows=hot_rows)
    assert rows_of(found, "key", F.round("erraticness", 6)) == rows_of(expected)


def test_nothing_is_lost_or_doubled(spark, small_chunks):
    rng = random.Random(8)
    rows = [(rng.choice([0, 0, 1, 2]), i, rng.randrange(400), rng.randrange(9)) for i in range(200)]
    source = at_seconds(spark, rows, "key long, seq long, t long, v long")
    on_time, too_late = late.late_split(source, "ts", ["seq"], 3 * SECOND, 100 * SECOND)
    assert rows_of(on_time.unionByName(too_late), "seq") == rows_of(source, "seq")
    gap = F.lit(2 * SECOND).cast("long")
    found = sessions.sessions(source, "key", "ts", gap, total=F.col("v"), hot_rows=50)
    total = found.agg(F.sum("length"), F.sum("total")).first()
    assert tuple(total) == (200, sum(row[3] for row in rows))
    closed = segments.stop_segments(source, "key", "ts", "v", "v", hot_rows=50)
    last_stop = {k: max((t for key, _, t, v in rows if key == k and v == 0), default=-1) for k in (0, 1, 2)}
    moving = sum(1 for k, _, t, v in rows if v and t <= last_stop[k])
    assert closed.agg(F.sum("length")).first()[0] == moving
