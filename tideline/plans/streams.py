"""Queries that run the streaming forms over whole tables until nothing is left.

Checkpoint and output lie in the cluster's shared folder. A bounded stream ends with a closing
row, later than all data, in a last micro-batch: it moves the watermark past every open window,
session and segment, and its own never closes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions.time import HOUR
from tideline.operators import time_windows as tw
from tideline.operators import words
from tideline.plans.registry import ARRIVAL, SQL, cents, load, query
from tideline.plans.rides import trip_sides
from tideline.session import start_keyed, use_utc, work_folder
from tideline.sources.lines import with_arrival
from tideline.sources.sinks import write_stream
from tideline.streaming import batches, folds, forms

#: What a micro-batch reads per core of the cluster. Spark's aggregations and the folds spread the
#: rows of a key, so a micro-batch may be as large as the cluster likes.
BYTES_PER_CORE = 256 << 20
#: What it reads for a keyed processor, if no single file is larger: all rows that a key brings in
#: one meet in one Python worker, decoded, so this is what one worker holds.
BYTES_PER_WORKER = 64 << 20
#: Event time of the closing row.
END = "2200-01-01 00:00:00"


def limit(spark: SparkSession, keyed: bool) -> dict[str, int]:
    """How much a micro-batch reads."""
    cores = spark.sparkContext.defaultParallelism
    return {"maxBytesPerTrigger": BYTES_PER_WORKER if keyed else BYTES_PER_CORE * cores}


def stream(
    spark: SparkSession, sf_dir: str, table: str, closing: str | None = None, keyed: bool = False
) -> DataFrame:
    """A table, a file or a folder of files, as a stream in the order in which its files came.

    ``closing`` is a folder that gets the closing row; ``keyed`` says that the rows of a key in a
    micro-batch meet in one worker."""
    use_utc(spark)
    schema = load(spark, sf_dir, table).schema
    reader = spark.readStream.schema(schema)
    # a plain path must be a folder; a pattern may also name one file
    rows = reader.options(**limit(spark, keyed)).parquet(f"{sf_dir.rstrip('/')}/{table}.parque[t]")
    return rows if closing is None else rows.unionByName(reader.parquet(closing))


def event_stream(spark, sf_dir, closing: str | None = None, keyed: bool = False) -> DataFrame:
    rows = stream(spark, sf_dir, "events", closing, keyed).withColumn("cents", cents("value"))
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))  # watermarks need this type


class ClosingRow:
    """A folder with nothing in it, until ``arrive`` puts an event without key and value there."""

    def __init__(self, spark: SparkSession, sf_dir: str, folder: str):
        self.folder = f"{folder}/closing"
        schema = load(spark, sf_dir, "events").schema
        values = [
            F.lit(END if field.name == "ts" else None).cast(field.dataType).alias(field.name)
            for field in schema.fields
        ]
        self.row = spark.range(1).select(*values)
        self.row.limit(0).write.parquet(self.folder)

    def arrive(self) -> None:
        self.row.write.mode("append").parquet(self.folder)


def finish(
    spark,
    sf_dir,
    name: str,
    build: Callable[[DataFrame], DataFrame],
    close: bool = False,
    keyed: bool = False,
):
    """Run ``build`` on the stream of events to its end and read what it wrote."""
    folder = work_folder(spark, name)
    last = ClosingRow(spark, sf_dir, folder) if close else None
    rows = build(event_stream(spark, sf_dir, last.folder if last else None, keyed))
    return _finished(rows, folder, last)


def _finished(rows: DataFrame, folder: str, last: ClosingRow | None = None) -> DataFrame:
    out = f"{folder}/out"

    def run():
        writer = write_stream(rows, "parquet", checkpoint=f"{folder}/checkpoint", target=out)
        start_keyed(writer).awaitTermination()

    run()
    if last is not None:
        last.arrive()
        run()
    return rows.sparkSession.read.schema(rows.schema).parquet(out)


def finish_batches(spark, sf_dir, name: str, build, make, mode="append", close=False) -> str:
    """Run a stream of events through a ``foreachBatch`` writer; returns its folder."""
    folder = work_folder(spark, name)
    last = ClosingRow(spark, sf_dir, folder) if close else None
    rows = build(event_stream(spark, sf_dir, last.folder if last else None))
    _run_batches(rows, folder, make, mode)
    if last is not None:
        last.arrive()
        _run_batches(rows, folder, make, mode)
    return folder


def _run_batches(rows: DataFrame, folder: str, make, mode: str = "append") -> None:
    writer = rows.writeStream.outputMode(mode).option("checkpointLocation", f"{folder}/checkpoint")
    writer.foreachBatch(make(folder)).trigger(availableNow=True).start().awaitTermination()


@query(SQL["word_count"])
def stream_word_count(spark, sf_dir):
    """Changed words per micro-batch; the newest count of each word counts."""
    counts = words.word_count(words.tokenize(stream(spark, sf_dir, "documents"), "text"))
    folder = work_folder(spark, "words")
    _run_batches(counts, folder, batches.changes_writer, "update")
    return batches.newest(spark.read.parquet(f"{folder}/out"), ["word"])


@query(SQL["hourly_top_driver"])
def stream_hourly_top_driver(spark, sf_dir):
    def build(rows):
        return forms.hourly_top_driver(rows, "ts", "user_id", "cents", "1 hour")

    return finish(spark, sf_dir, "top", build, close=True)


@query(SQL["sliding_event_time"])
def stream_sliding_count(spark, sf_dir):
    def build(rows):
        return forms.window_count(rows, "ts", "1 hour", "2 hours", "1 hour", ["user_id"])

    return finish(spark, sf_dir, "sliding", build, close=True)


@query()
def stream_arrival_window_count(spark, sf_dir):
    """Events and their amounts per type and minute of arrival; the closing row arrives at the end."""
    folder = work_folder(spark, "arrival")
    last = ClosingRow(spark, sf_dir, folder)
    given = stream(spark, sf_dir, "events")
    closing = spark.readStream.schema(given.schema).parquet(last.folder)
    closing = closing.withColumn("arrived", F.lit(END).cast("timestamp"))
    rows = with_arrival(given)
    rows = rows.unionByName(closing).withColumn("cents", cents("value"))
    found = tw.time_window(
        rows.withWatermark("arrived", "0 seconds"),
        "arrived",
        "1 minute",
        keys=["event_type"],
        n=F.count("event_id"),
        total=F.sum("cents"),
    )
    return _finished(found, folder, last)


def _with_throttle(rows: DataFrame) -> DataFrame:
    return rows.withColumn("throttle", (F.col("cents") % 1000) / 100)


@query(SQL["driving_sessions"])
def stream_driving_sessions(spark, sf_dir):
    def build(rows):
        return forms.driving_sessions(
            _with_throttle(rows), "user_id", "ts", "value", "throttle", "6 hours", "1 hour"
        )

    found = finish(spark, sf_dir, "sessions", build, close=True)
    return found.withColumn("erraticness", F.round("erraticness", 4))


@query(SQL["session_dynamic_gap"])
def stream_session_dynamic_gap(spark, sf_dir):
    kind = F.col("event_type")
    gap = F.when(kind == "view", "4 hours").when(kind == "purchase", "8 hours").otherwise("2 hours")

    def build(rows):
        return forms.dynamic_sessions(rows, "user_id", "ts", gap, "cents", "1 hour")

    return finish(spark, sf_dir, "gaps", build, close=True)


def _folded(spark, sf_dir, name: str, columns: list[str], make) -> DataFrame:
    """What a writer of folds put out over the whole stream of events."""
    folder = finish_batches(spark, sf_dir, name, lambda rows: rows.select(*columns), make)
    return spark.read.parquet(f"{folder}/out").drop("batch")


KEYED = ["user_id", "event_id", "cents"]


def _counted(spark, sf_dir, every, size=None):
    def make(path):
        return folds.counted_writer(path, "user_id", ["event_id"], "cents", every, size)

    return _folded(spark, sf_dir, "counted", KEYED, make)


@query(SQL["count_avg"])
def stream_count_avg(spark, sf_dir):
    found = _counted(spark, sf_dir, 3, 3)
    average = F.round(F.col("total") / F.col("given"), 4)
    return found.select("user_id", F.expr("rn div 3").alias("block"), average.alias("average"))


def _average(spark, sf_dir, store):
    def build(rows):
        return forms.count_average(rows, "user_id", ["event_id"], "cents", 3, store)

    found = finish(spark, sf_dir, f"average-{store}", build, keyed=True)
    return found.withColumn("average", F.round("average", 4))


@query(SQL["count_avg"])
def stream_count_avg_list(spark, sf_dir):
    return _average(spark, sf_dir, "list")


@query(SQL["count_avg"])
def stream_count_avg_map(spark, sf_dir):
    return _average(spark, sf_dir, "map")


@query(SQL["count_window_cumulative"])
def stream_count_window_cumulative(spark, sf_dir):
    return _counted(spark, sf_dir, 3).drop("given")


@query(SQL["count_window_sliding"])
def stream_count_window_sliding(spark, sf_dir):
    return _counted(spark, sf_dir, 2, 3).drop("given")


@query(SQL["count_window_tumbling"])
def stream_count_window_tumbling(spark, sf_dir):
    found = _counted(spark, sf_dir, 3, 3)
    return found.select("user_id", F.expr("rn div 3").alias("block"), "total")


def _running(spark, sf_dir, with_text):
    def make(path):
        return folds.running_writer(path, "user_id", ["event_id"], "cents", with_text)

    return _folded(spark, sf_dir, "fold", KEYED, make)


@query(SQL["running_sum"])
def stream_running_sum(spark, sf_dir):
    return _running(spark, sf_dir, False).select("event_id", "user_id", "total")


@query(SQL["running_text"])
def stream_running_text(spark, sf_dir):
    return _running(spark, sf_dir, True).select("event_id", "user_id", "text")


@query(SQL["join_slots"])
def stream_join_slots(spark, sf_dir):
    def build(rows):
        return rows.filter(F.col("event_type").isin("view", "purchase")).select(
            "user_id",
            F.col("event_id").alias("seq"),
            (F.col("event_type") == "view").alias("is_left"),
            "event_id",
        )

    def make(path):
        return folds.slots_writer(path, "user_id", "seq", "is_left", "event_id")

    folder = finish_batches(spark, sf_dir, "slots", build, make)
    found = spark.read.parquet(f"{folder}/out").drop("batch")
    return found.withColumnRenamed("seq", "event_id")


@query(
    """SELECT p.event_id, p.user_id FROM events p WHERE p.event_type <> 'error' AND NOT EXISTS
        (SELECT 1 FROM events e WHERE e.event_type = 'error' AND e.user_id = p.user_id
            AND e.event_id < p.event_id)"""
)
def stream_blocklist(spark, sf_dir):
    """A user's events pass until the user's first error."""

    def make(path):
        return folds.blocklist_writer(path, F.col("event_type") == "error", "user_id", "event_id")

    found = _folded(spark, sf_dir, "blocked", ["user_id", "event_id", "event_type"], make)
    return found.filter("event_type IS NOT NULL").select("event_id", "user_id")


@query(SQL["rules_asof"])
def stream_rules_asof(spark, sf_dir):
    """A signup sets the largest amount that may pass in its group of users, from its arrival on."""

    def build(rows):
        return rows.select("event_id", (F.col("user_id") % 64).alias("grp"), "event_type", "cents")

    def make(path):
        cents_ = F.col("cents")
        return folds.rules_writer(path, F.col("event_type") == "signup", "grp", cents_, cents_, ["event_id"])

    folder = finish_batches(spark, sf_dir, "rules", build, make)
    found = spark.read.parquet(f"{folder}/out")
    return found.select("event_id", "grp", "cents", F.coalesce("rule", F.lit(-1)).alias("rule"))


@query(SQL["join_rides_fares"])
def stream_join_rides_fares(spark, sf_dir):
    """Open orders stand for started rides, their lines for fares, joined on the ride's id.

    A fare is forgotten once it has met its ride. (The dates of these tables come in no order, so
    no watermark bounds the join; ``forms.join_rides_fares`` is for those that do.)
    """
    fares, started = trip_sides(stream(spark, sf_dir, "lineitem"), stream(spark, sf_dir, "orders"))
    started = started.withColumn("is_ride", F.lit(True))
    rows = fares.withColumn("is_ride", F.lit(False)).unionByName(started, allowMissingColumns=True)
    folder = work_folder(spark, "join")

    def make(path):
        return folds.matched_writer(path, "is_ride", "l_orderkey", ["o_custkey"], ["l_linenumber", "fare"])

    _run_batches(rows, folder, make)
    return spark.read.parquet(f"{folder}/out").drop("batch")


@query(SQL["stop_segments"])
def stream_stop_segments(spark, sf_dir):
    stop = F.col("event_type") == "error"

    def build(rows):
        return forms.stop_segments(
            _with_throttle(rows), "user_id", "ts", "value", "throttle", "1 hour", stop
        )

    found = finish(spark, sf_dir, "segments", build, close=True, keyed=True)
    return found.withColumn("erraticness", F.round("erraticness", 4))


def _arrivals(rows: DataFrame) -> DataFrame:
    """Events in the disturbed order of their arrival."""
    shift = (F.col("event_id") * 7919) % 23
    rows = rows.withColumn("seq", F.coalesce(F.col("event_id") + shift, F.lit(2**62)))
    return rows.select("event_id", "seq", "ts", "event_type", "user_id")


def _sorted(spark, sf_dir) -> str:
    def make(path):
        return batches.sorter_writer(path, "user_id", "ts", ARRIVAL, HOUR)

    return finish_batches(spark, sf_dir, "sorter", _arrivals, make, close=True)


@query(SQL["car_sort"])
def stream_car_sort(spark, sf_dir):
    found = spark.read.parquet(f"{_sorted(spark, sf_dir)}/out")
    return found.select("user_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "event_id")


@query(SQL["car_late_ids"])
def stream_car_late_ids(spark, sf_dir):
    return spark.read.parquet(f"{_sorted(spark, sf_dir)}/late").select("event_id")


@query(SQL["tumbling_event_time"])
def stream_window_elements(spark, sf_dir):
    """The elements of each closed window in arrival order; late rows are left out."""

    def make(path):
        return batches.window_elements_writer(path, "user_id", "ts", ARRIVAL, HOUR, HOUR)

    folder = finish_batches(spark, sf_dir, "elements", _arrivals, make, close=True)
    return spark.read.parquet(f"{folder}/out").drop("batch")


def _late(spark, sf_dir, name, *options):
    def make(path):
        return batches.late_split_writer(path, "ts", ARRIVAL, HOUR, HOUR, *options)

    folder = finish_batches(spark, sf_dir, name, _arrivals, make)
    found = spark.read.parquet(f"{folder}/out")
    return found.select("event_id", "window_start", "window_end", F.col("late").cast("boolean"))


@query(SQL["late_split"])
def stream_late_split(spark, sf_dir):
    return _late(spark, sf_dir, "late")


@query(SQL["late_split_marker"])
def stream_late_split_marker(spark, sf_dir):
    return _late(spark, sf_dir, "marker", HOUR // 6, F.col("event_type") == "signup")


@query(SQL["dynamic_rule_filter"])
def stream_dynamic_rule(spark, sf_dir):
    """A signup sets the largest amount that may pass, from its arrival on."""

    def build(rows):
        return rows.select("event_id", "event_type", "cents")

    def make(path):
        return batches.dynamic_rule_writer(
            path, F.col("event_type") == "signup", F.col("cents"), F.col("cents"), ["event_id"]
        )

    folder = finish_batches(spark, sf_dir, "rule", build, make)
    found = spark.read.parquet(f"{folder}/out")
    return found.select("event_id", "cents", F.coalesce("rule", F.lit(-1)).alias("rule"))


@query(SQL["sink_batches"])
def stream_sink_batches(spark, sf_dir):
    def build(rows):
        return rows.select("event_id", "cents")

    def make(path):
        return batches.batched_writer(path, ["event_id"], 20)

    folder = finish_batches(spark, sf_dir, "batches", build, make)
    given = load(spark, sf_dir, "events").withColumn("cents", cents("value"))
    found = batches.read_batches(build(given), folder)
    return found.groupBy("batch_no").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("event_id").alias("first_id"),
        F.max("event_id").alias("last_id"),
        F.sum("cents").alias("total"),
    )
