"""Streaming forms, fed in several micro-batches with restarts, against the batch forms."""

import random
import time

import pandas as pd
import pytest
from conftest import rows_of
from pyspark.sql import functions as F
from test_records import CAR
from test_windows import at_seconds as since_epoch

from tideline.functions.time import SECOND
from tideline.operators import count_windows as cw
from tideline.operators import control, late, pairing, segments, sessions, time_windows, words
from tideline.sources.lines import read_lines
from tideline.sources.sinks import write_stream
from tideline.streaming import batches, forms, processors


def at_seconds(spark, rows, schema="key string, t long"):
    """Spark's first watermark is the epoch, so streams start an hour after it."""
    source = since_epoch(spark, rows, schema)
    return source.withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 HOUR"))


class Feed:
    """A folder of files that a stream reads; each ``add`` is one micro-batch."""

    def __init__(self, spark, folder, schema):
        self.spark, self.folder, self.schema = spark, str(folder), schema
        self.source = f"{self.folder}/in"

    def stream(self):
        return self.spark.readStream.schema(self.schema).parquet(self.source)

    def add(self, df):
        df.coalesce(1).write.mode("append").parquet(self.source)

    def run(self, rows, name="x", mode="append"):
        out = f"{self.folder}/{name}"
        writer = write_stream(rows, "parquet", checkpoint=f"{out}-state", target=out, mode=mode)
        writer.start().awaitTermination()
        return self.spark.read.schema(rows.schema).parquet(out)

    def run_batches(self, rows, write, name="b"):
        writer = rows.writeStream.option("checkpointLocation", f"{self.folder}/{name}-state")
        writer.foreachBatch(write).trigger(availableNow=True).start().awaitTermination()


def in_parts(feed, df, build, parts, order="seq"):
    """Run a stream over ``df`` in ``parts`` micro-batches, each after a restart."""
    total = df.count()
    found = None
    for i in range(parts):
        low, high = total * i // parts, total * (i + 1) // parts
        feed.add(df.filter((F.col(order) >= low) & (F.col(order) < high)))
        found = feed.run(build(feed.stream()))
    return found


def keyed_rows(spark, n=90, seed=1):
    rng = random.Random(seed)
    rows = [(rng.randrange(4), rng.randrange(20), i) for i in range(n)]
    return spark.createDataFrame(rows, "key long, value long, seq long")


@pytest.mark.parametrize("store", ["value", "list", "map"])
def test_count_average(spark, tmp_path, store):
    source = keyed_rows(spark)
    feed = Feed(spark, tmp_path, source.schema)
    found = in_parts(
        feed, source, lambda s: forms.count_average(s, "key", ["seq"], "value", 3, store), 3
    )
    expected = cw.count_average(source, "key", ["seq"], "value")
    assert rows_of(found.withColumn("average", F.round("average", 9))) == rows_of(
        expected.withColumn("average", F.round("average", 9))
    )


def test_counted_windows(spark, tmp_path):
    source = keyed_rows(spark)
    cases = {
        "c": ((3, None), cw.count_window_cumulative(source, "key", ["seq"], "value", 3)),
        "s": ((2, 3), cw.count_window_sliding(source, "key", ["seq"], "value", 3, 2)),
    }
    for name, ((every, size), expected) in cases.items():
        feed = Feed(spark, tmp_path / name, source.schema)
        found = in_parts(
            feed, source, lambda s: forms.count_window(s, "key", ["seq"], "value", every, size), 2
        )
        assert rows_of(found) == rows_of(expected)


def test_running_folds(spark, tmp_path):
    source = keyed_rows(spark, 40)
    feed = Feed(spark, tmp_path, source.schema)
    found = in_parts(feed, source, lambda s: forms.running_fold(s, "key", ["seq"], "value"), 3)
    sums = rows_of(cw.running_sum(source, "key", ["seq"], "value"), "seq", "total")
    texts = rows_of(cw.running_text(source, "key", ["seq"], "value"), "seq", "text")
    assert rows_of(found, "seq", "total") == sums and rows_of(found, "seq", "text") == texts


def wait_for(spark, table, rows):
    for _ in range(120):
        if spark.table(table).count() >= rows:
            return
        time.sleep(0.5)
    raise AssertionError(f"{table} has only {spark.table(table).count()} rows")


def test_state_with_a_time_to_live(spark, tmp_path):
    source = keyed_rows(spark, 12)
    feed = Feed(spark, tmp_path, source.schema)
    feed.add(source)
    rows = forms.running_fold(feed.stream(), "key", ["seq"], "value", ttl_ms=1)
    # With wall-clock state a stream has always more to do, so it is stopped by hand.
    writer = write_stream(
        rows, "memory", checkpoint=str(tmp_path / "c"), target="ttl", every="200 milliseconds"
    )
    query = writer.start()
    try:
        wait_for(spark, "ttl", 12)
        feed.add(source.withColumn("seq", F.col("seq") + 100))
        wait_for(spark, "ttl", 24)
    finally:
        query.stop()
    found = spark.table("ttl")
    # The sums start again, as the state of the first rows has expired.
    first = rows_of(found.filter("seq < 100"), "seq", "total")
    again = rows_of(found.filter("seq >= 100").withColumn("seq", F.col("seq") - 100), "seq", "total")
    assert first == again


def test_slots(spark, tmp_path):
    rng = random.Random(4)
    rows = [(rng.randrange(3), i, rng.random() < 0.4, f"r{i}") for i in range(80)]
    source = spark.createDataFrame(rows, "key long, seq long, is_left boolean, id string")
    feed = Feed(spark, tmp_path, source.schema)
    found = in_parts(feed, source, lambda s: forms.pair_slots(s, "key", "seq", "is_left", "id"), 4)
    assert rows_of(found) == rows_of(pairing.pair_slots(source, "key", "seq", "is_left", "id"))


def test_blocklist(spark, tmp_path):
    words_ = spark.createDataFrame(
        [("data", 0), ("DROP", 1), ("DROP", 3), ("artisans", 4), ("IGNORE", 5), ("DROP", 5)],
        "word string, seq long",
    )
    names = spark.createDataFrame([("DROP", 2), ("IGNORE", 4)], "word string, seq long")
    both = words_.withColumn("is_name", F.lit(False)).unionByName(names.withColumn("is_name", F.lit(True)))
    feed = Feed(spark, tmp_path, both.schema)

    def build(stream):
        named = stream.filter("is_name")
        return forms.blocklist(stream.filter("NOT is_name"), named, "word", "seq", ["seq"])

    for low, high in ((0, 3), (3, 9)):
        feed.add(both.filter(F.col("seq").between(low, high - 1)))
        found = feed.run(build(feed.stream()))
    assert rows_of(found) == [("DROP", 1), ("artisans", 4), ("data", 0)]


def car_rows(spark):
    rows = [(s, id, float(v), float(t), sec) for s, id, v, t, sec in CAR]
    source = at_seconds(spark, rows, "seq long, id string, speed double, throttle double, t long")
    return source.drop("t").withColumn("car", F.lit("c1"))


def closing_row(spark, second):
    """An event of another car that moves the watermark."""
    row = [(1000, "end", 1.0, 1.0, second)]
    source = at_seconds(spark, row, "seq long, id string, speed double, throttle double, t long")
    return source.drop("t").withColumn("car", F.lit("other"))


def test_stop_segments(spark, tmp_path):
    source = car_rows(spark)
    feed = Feed(spark, tmp_path, source.schema)
    for part in (source.filter("seq <= 4"), source.filter("seq > 4"), closing_row(spark, 500)):
        feed.add(part)
        found = feed.run(forms.stop_segments(feed.stream(), "car", "ts", "speed", "throttle", "30 seconds"))
    columns = ["car", "start_time", "stop_time", "length", "max_speed", F.round("erraticness", 6), "manner"]
    expected = segments.stop_segments(source, "car", "ts", "speed", "throttle")
    assert rows_of(found, *columns) == rows_of(expected, *columns)


def sorter_parts(feed, source, write):
    for part in (source.filter("seq <= 5"), source.filter("seq > 5"), closing_row(feed.spark, 500)):
        feed.add(part)
        feed.run_batches(feed.stream(), write)


def test_event_sorter_has_two_disjoint_outputs(spark, tmp_path):
    source = car_rows(spark)
    feed = Feed(spark, tmp_path, source.schema)
    folder = str(tmp_path / "sorter")
    sorter_parts(feed, source, batches.sorter_writer(folder, "car", "ts", ["seq"], 30 * SECOND))
    mine = spark.read.parquet(f"{folder}/out").filter("car = 'c1'")
    assert [r.id for r in mine.orderBy("ts").collect()] == ["e1", "e2", "e3", "e4", "e5", "e6", "e8", "e9"]
    late_rows = spark.read.parquet(f"{folder}/late")
    assert rows_of(late_rows, "id") == [("e7",)]
    on_time, too_late = late.sorter_split(source, "ts", ["seq"], 30 * SECOND)
    assert rows_of(mine, "seq") == rows_of(on_time, "seq")
    assert rows_of(late_rows, "seq") == rows_of(too_late, "seq")
    # What is written is already in order, file by file.
    files = {}
    for row in mine.withColumn("file", F.input_file_name()).collect():
        files.setdefault(row.file, []).append(row.ts)
    assert files and all(times == sorted(times) for times in files.values())
    # Only what the last two micro-batches need is still there.
    assert sorted(x.name for x in (tmp_path / "sorter/held").iterdir()) == ["batch=1", "batch=2"]


def test_sessions(spark, tmp_path):
    source = car_rows(spark)
    feed = Feed(spark, tmp_path, source.schema)
    for part in (source.filter("seq <= 5"), source.filter("seq > 5"), closing_row(spark, 500)):
        feed.add(part)
        found = feed.run(
            forms.driving_sessions(feed.stream(), "car", "ts", "speed", "throttle", "15 seconds", "60 seconds")
        )
    expected = sessions.driving_sessions(source, "car", "ts", "speed", "throttle", 15 * SECOND)
    columns = ["session_start", "session_end", "length", "max_speed", F.round("erraticness", 6), "manner"]
    assert rows_of(found.filter("car = 'c1'"), *columns) == rows_of(expected, *columns)


def test_dynamic_sessions_and_window_counts(spark, tmp_path):
    rows = [(k, t) for k, ts in {"this": (0, 10, 21), "is": (0, 19), "example": (0, 4, 10)}.items() for t in ts]
    source = at_seconds(spark, [*rows, ("end", 900)]).withColumn("one", F.lit(1))
    feed = Feed(spark, tmp_path, source.schema)
    feed.add(source)
    gap = F.when(F.col("key") == "this", "10 seconds").when(F.col("key") == "is", "20 seconds")
    found = feed.run(
        forms.dynamic_sessions(feed.stream(), "key", "ts", gap.otherwise("5 seconds"), "one", "5 seconds")
    )
    expected = [("this", 2), ("this", 1), ("is", 2), ("example", 2), ("example", 1)]
    assert rows_of(found, "key", "total") == sorted(expected, key=repr)
    counts = feed.run(
        forms.window_count(feed.stream(), "ts", "5 seconds", "10 seconds", "5 seconds", ["key"]), "counts"
    )
    batch = time_windows.window_count(source, "ts", "10 seconds", "5 seconds", ["key"])
    assert rows_of(counts) == rows_of(batch.filter("key <> 'end'"))


def test_window_elements(spark, tmp_path):
    rows = [(i, i % 2, t) for i, t in enumerate((0, 1, 2, 4, 5, 17, 1, 2))] + [(100, 9, 900)]
    source = at_seconds(spark, rows, "seq long, key long, t long")
    feed = Feed(spark, tmp_path, source.schema)
    folder = str(tmp_path / "elements")
    write = batches.window_elements_writer(folder, "key", "ts", ["seq"], 3 * SECOND, 10 * SECOND)
    for low, high in ((0, 2), (3, 5), (6, 100)):
        feed.add(source.filter(F.col("seq").between(low, high)))
        feed.run_batches(feed.stream(), write)
    on_time, too_late = late.late_split(source, "ts", ["seq"], 3 * SECOND, 10 * SECOND)
    # All windows but that of the last row are closed by it.
    expected = late.window_elements(on_time.filter("key < 9"), "key", "ts", ["seq"])
    found = spark.read.parquet(f"{folder}/out")
    assert rows_of(found, *expected.columns) == rows_of(expected)
    assert rows_of(spark.read.parquet(f"{folder}/late"), "seq") == rows_of(too_late, "seq") != []


def test_windows_of_an_idle_source_close_by_a_heartbeat(spark, tmp_path):
    """Rows stop; beats go on, in a source of their own."""
    rows = Feed(spark, tmp_path / "rows", "key string, t long, ts timestamp")
    beats = Feed(spark, tmp_path / "beats", "key string, t long, ts timestamp")
    rows.add(at_seconds(spark, [("a", 1), ("a", 2), ("b", 7), (None, 8)]))
    beats.add(at_seconds(spark, [("x", 1)]))

    def run():
        counts = forms.live_window_count(rows.stream(), beats.stream(), "ts", "1 second", "5 seconds", ["key"])
        return rows_of(rows.run(counts), "window_start", "key", "n")

    # the rows themselves close the first window, and no other
    assert [row[1:] for row in run()] == [("a", 2)]
    assert [row[1:] for row in run()] == [("a", 2)]
    beats.add(at_seconds(spark, [("x", 30)]))
    assert sorted((row[1:] for row in run()), key=repr) == [("a", 2), ("b", 1), (None, 1)]


def test_hourly_top_driver(spark, tmp_path):
    rng = random.Random(9)
    rows = [(i, rng.randrange(5), rng.randrange(90), i * 120) for i in range(200)]
    rows.append((200, 0, 0, 10**6))
    source = at_seconds(spark, rows, "seq long, driver long, tip long, t long")
    feed = Feed(spark, tmp_path, source.schema)
    found = in_parts(
        feed, source, lambda s: forms.hourly_top_driver(s, "ts", "driver", "tip", "10 minutes"), 2
    )
    expected = time_windows.hourly_top_driver(source, "ts", "driver", "tip")
    assert rows_of(found) == rows_of(expected.filter("window_end < '1970-01-02'"))


def test_ride_fare_join(spark, tmp_path):
    rides = at_seconds(spark, [("a", 0), ("b", 5), ("c", 9)]).select("key", F.col("ts").alias("ride_ts"))
    fares = at_seconds(spark, [("a", 8), ("b", 400), ("c", 2)]).select("key", F.col("ts").alias("fare_ts"))
    left, right = Feed(spark, tmp_path / "l", rides.schema), Feed(spark, tmp_path / "r", fares.schema)
    left.add(rides)
    right.add(fares)
    joined = forms.join_rides_fares(left.stream(), right.stream(), "key", "ride_ts", "fare_ts", "60 seconds")
    assert rows_of(left.run(joined), "key") == [("a",), ("c",)]


def test_word_count_in_update_mode(spark, tmp_path):
    lines = spark.createDataFrame([("this is an example",), ("this is the first example",)], "value string")
    feed = Feed(spark, tmp_path, lines.schema)
    feed.add(lines)
    counts = words.word_count(words.tokenize(feed.stream()))
    write = batches.changes_writer(str(tmp_path / "words"))

    def run():
        writer = counts.writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "c"))
        writer.foreachBatch(write).trigger(availableNow=True).start().awaitTermination()
        return spark.read.parquet(str(tmp_path / "words/out"))

    assert dict(rows_of(batches.newest(run(), ["word"])))["this"] == 2
    feed.add(spark.createDataFrame([("this time",)], "value string"))
    changes = run()
    # only the words that changed are written again
    assert rows_of(changes.filter("batch = 1"), "word", "n") == [("this", 3), ("time", 1)]
    assert dict(rows_of(batches.newest(changes, ["word"])))["example"] == 2


def test_late_split_across_batches(spark, tmp_path):
    rng = random.Random(5)
    rows = [(i, i + rng.randrange(-20, 20) + 20) for i in range(90)]
    source = at_seconds(spark, rows, "seq long, t long")
    feed = Feed(spark, tmp_path, source.schema)
    write = batches.late_split_writer(str(tmp_path / "late"), "ts", ["seq"], 3 * SECOND, 10 * SECOND)
    for i in range(3):
        feed.add(source.filter(F.col("seq").between(30 * i, 30 * i + 29)))
        feed.run_batches(feed.stream(), write)
    found = spark.read.parquet(str(tmp_path / "late/out")).withColumn("late", F.col("late").cast("boolean"))
    expected = late.late_rows(source, "ts", ["seq"], 3 * SECOND, 10 * SECOND)
    assert rows_of(found, "seq", "late") == rows_of(expected, "seq", "late")
    # The last batch may be run again and changes nothing.
    write(source.filter(F.col("seq").between(60, 89)), 2)
    again = spark.read.parquet(str(tmp_path / "late/out")).withColumn("late", F.col("late").cast("boolean"))
    assert rows_of(again, "seq", "late") == rows_of(expected, "seq", "late")


def test_dynamic_rule_across_batches(spark, tmp_path):
    rows = [(0, None, "hello world"), (1, 5, None), (2, None, "hello"), (3, None, "worlds"), (4, 10, None), (5, None, "worlds")]
    source = spark.createDataFrame(rows, "seq long, n long, line string")
    options = F.col("n").isNotNull(), F.col("n"), F.length("line"), ["seq"]
    expected = control.dynamic_rule_filter(source, *options)
    for name, cuts in {"a": ((0, 5),), "b": ((0, 0), (1, 3), (4, 5)), "c": ((0, 2), (3, 3), (4, 4), (5, 5))}.items():
        feed = Feed(spark, tmp_path / name, source.schema)
        write = batches.dynamic_rule_writer(str(tmp_path / name / "rule"), *options)
        for low, high in cuts:
            feed.add(source.filter(F.col("seq").between(low, high)))
            feed.run_batches(feed.stream(), write)
        found = spark.read.parquet(str(tmp_path / name / "rule/out"))
        assert rows_of(found, "seq", "rule") == rows_of(expected, "seq", "rule")


@pytest.mark.parametrize("cuts", [(45,), (3, 3, 34, 5), (20, 20, 5), (40, 5), (30, 30)])
def test_batched_sink(spark, tmp_path, cuts):
    source = spark.range(sum(cuts)).withColumnRenamed("id", "seq")
    feed = Feed(spark, tmp_path, source.schema)
    folder = str(tmp_path / "sink")
    write = batches.batched_writer(folder, ["seq"], 20)
    low = 0
    for n in cuts:
        feed.add(source.filter(F.col("seq").between(low, low + n - 1)))
        feed.run_batches(feed.stream(), write)
        low += n
    # A micro-batch that is run again changes nothing.
    write(source.filter(F.col("seq") >= low - cuts[-1]), len(cuts) - 1)
    found = batches.read_batches(source, folder)
    expected = cw.sink_batches(source, ["seq"], 20)
    assert rows_of(found) == rows_of(expected)
    full = spark.read.parquet(f"{folder}/out")
    assert full.groupBy("batch_no").count().filter("count <> 20").count() == 0


def test_nulls_and_doubles_in_keyed_streams(spark, tmp_path):
    rng = random.Random(3)
    rows = [
        (rng.choice([None, 1, 2]), rng.choice([None, 1.5, 2.25, -3.125, 1e9]), i) for i in range(80)
    ]
    source = spark.createDataFrame(rows, "key long, value double, seq long")
    builds = {
        "fold": (
            lambda s: forms.running_fold(s, "key", ["seq"], "value", with_text=False).drop("text"),
            cw.running_sum(source, "key", ["seq"], "value").select("key", "seq", "total"),
        ),
        "text": (
            lambda s: forms.running_fold(s, "key", ["seq"], "value").drop("total"),
            cw.running_text(source, "key", ["seq"], "value").select("key", "seq", "text"),
        ),
        "cumulative": (
            lambda s: forms.count_window(s, "key", ["seq"], "value", 3),
            cw.count_window_cumulative(source, "key", ["seq"], "value", 3),
        ),
        "sliding": (
            lambda s: forms.count_window(s, "key", ["seq"], "value", 2, 3),
            cw.count_window_sliding(source, "key", ["seq"], "value", 3, 2),
        ),
    }
    for store in ("value", "list", "map"):
        builds[store] = (
            lambda s, store=store: forms.count_average(s, "key", ["seq"], "value", 3, store),
            cw.count_average(source, "key", ["seq"], "value"),
        )
    for name, (build, expected) in builds.items():
        feed = Feed(spark, tmp_path / name, source.schema)
        found = in_parts(feed, source, build, 3)
        assert rows_of(found) == rows_of(expected), name


def test_slots_with_null_payloads(spark, tmp_path):
    rows = [(1, i, i % 3 == 0, None if i % 2 else f"r{i}") for i in range(30)]
    source = spark.createDataFrame(rows, "key long, seq long, is_left boolean, id string")
    feed = Feed(spark, tmp_path, source.schema)
    found = in_parts(feed, source, lambda s: forms.pair_slots(s, "key", "seq", "is_left", "id"), 3)
    assert rows_of(found) == rows_of(pairing.pair_slots(source, "key", "seq", "is_left", "id"))


def test_segments_with_nulls(spark, tmp_path):
    rows = [(s, id, None if s % 2 else float(v), None if s % 3 == 1 else float(t), sec) for s, id, v, t, sec in CAR]
    source = at_seconds(spark, rows, "seq long, id string, speed double, throttle double, t long")
    source = source.drop("t").withColumn("car", F.lit("c1")).withColumn("stops", F.col("seq").isin(4, 8))
    end = closing_row(spark, 500).withColumn("stops", F.lit(False))
    feed = Feed(spark, tmp_path, source.schema)
    for part in (source.filter("seq <= 4"), source.filter("seq > 4"), end):
        feed.add(part)
        stream = forms.stop_segments(feed.stream(), "car", "ts", "speed", "throttle", "30 seconds", F.col("stops"))
        found = feed.run(stream)
    columns = ["car", "start_time", "stop_time", "length", "max_speed", F.round("erraticness", 6), "manner"]
    expected = segments.stop_segments(source, "car", "ts", "speed", "throttle", F.col("stops"))
    assert rows_of(found, *columns) == rows_of(expected, *columns)


def test_a_long_segment_keeps_a_summary(spark):
    """What a key holds follows the rows of one delay, not the length of its open segment."""

    class Value:
        def __init__(self):
            self.now = None

        def exists(self):
            return self.now is not None

        def get(self):
            return self.now

        def update(self, value):
            self.now = value

        def clear(self):
            self.now = None

    class Rows(Value):
        def get(self):
            return iter(self.now or [])

        def appendList(self, rows):
            self.now = [*(self.now or []), *rows]

        put = Value.update

    class Handle:
        def __init__(self):
            self.timers = set()

        def getValueState(self, *_):
            return Value()

        def getListState(self, *_):
            return Rows()

        def registerTimer(self, at):
            self.timers.add(at)

        deleteTimer = property(lambda self: self.timers.discard)

    class Mark:
        def __init__(self, ms):
            self.ms = ms

        def getCurrentWatermarkInMs(self):
            return self.ms

    processor = processors.StopSegments()
    processor.names = ["car", "start_at", "stop_at", "length", "max_speed", "erraticness"]
    handle = Handle()
    processor.init(handle)
    read = []
    for step in range(50):
        at = [(1000 * step + i) * 1000 for i in range(0, 1000, 100)]
        rows = pd.DataFrame({"at": at, "is_stop": False, "speed": 1.0, "throttle": [float(x % 7) for x in at]})
        list(processor.handleInputRows(("c",), iter([rows]), None))
        due = [timer for timer in handle.timers if timer <= 1000 * step]
        if due:
            read.append(len(processor.held.now))
            handle.timers -= set(due)
            assert not list(processor.handleExpiredTimer(("c",), Mark(1000 * step), None))
    assert len(read) > 40 and max(read) <= 20 and processor.segment.now[0] > 450


def test_idle_count(spark, tmp_path):
    source = spark.createDataFrame([("a",), ("a",), ("b",)], "key string")
    feed = Feed(spark, tmp_path, source.schema)
    feed.add(source)
    rows = forms.idle_count(feed.stream(), "key", 500)
    writer = write_stream(rows, "memory", checkpoint=str(tmp_path / "c"), target="idle", every="200 milliseconds")
    running = writer.start()
    try:
        wait_for(spark, "idle", 2)
    finally:
        running.stop()
    assert rows_of(spark.table("idle")) == [("a", 2), ("b", 1)]


def test_console_sink_and_socket_source(spark, tmp_path):
    feed = Feed(spark, tmp_path, "key long")
    feed.add(spark.range(3).withColumnRenamed("id", "key"))
    query = write_stream(feed.stream(), "console", checkpoint=str(tmp_path / "c")).start()
    query.awaitTermination()
    assert query.exception() is None
    # Described only; nothing connects before a stream starts.
    lines = read_lines(spark, "socket", "localhost:9", stream=True)
    assert lines.isStreaming and lines.columns == ["value"]


def test_unknown_sink(spark, tmp_path):
    with pytest.raises(ValueError):
        write_stream(spark.readStream.format("rate").load(), "tape", checkpoint=str(tmp_path))
