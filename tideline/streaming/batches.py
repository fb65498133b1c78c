"""Streaming forms that work per micro-batch, through ``foreachBatch``.

What all rows share (the newest rule, the largest event time, how many rows there were) is one
row; rows that wait for the watermark, or for a batch to fill, are a table. Both are written per
micro-batch below the folder, under the batch's number, and a batch reads what the number before
it left. A batch that is run again thus finds the same state and replaces its output. What no
batch can need any more is removed.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tideline.functions.time import micros
from tideline.operators import control, late
from tideline.operators.count_windows import sink_batches
from tideline.session import remove_folder

Write = Callable[[DataFrame, int], None]


def _left(batch: DataFrame, folder: str, kind: str, batch_id: int, schema) -> DataFrame:
    """The table of a kind that the batch before this one left (empty before the first)."""
    spark = batch.sparkSession
    if batch_id == 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{folder}/{kind}/batch={batch_id - 1}")


def _leave(rows: DataFrame, folder: str, kind: str, batch_id: int) -> None:
    rows.write.mode("overwrite").parquet(f"{folder}/{kind}/batch={batch_id}")


def _forget(batch: DataFrame, folder: str, batch_id: int, *kinds: str) -> None:
    """Remove the tables that only batches before this one could read."""
    for kind in kinds:
        if batch_id > 1:
            remove_folder(batch.sparkSession, f"{folder}/{kind}/batch={batch_id - 2}")


def _marked_writer(
    folder: str,
    ts: str,
    marker: Column | None,
    split: Callable[[DataFrame, Column], DataFrame],
    delay_micros: int = 0,
    due: Column | None = None,
    emit: Callable[[DataFrame], DataFrame] | None = None,
) -> Write:
    """Write ``split(batch, largest event time so far)``, and carry that time on.

    With ``due`` (microseconds) rows that are not late are held until the watermark has reached
    that moment, and come out through ``emit``; late rows go to a folder of their own. So each
    row is in exactly one output.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        seen = _left(batch, folder, "state", batch_id, "seen long").first()
        start = F.lit(seen["seen"] if seen else None).cast("long")
        rows = split(batch, start).persist()
        moving = rows if marker is None else rows.filter(marker)
        newest = moving.agg(F.greatest(F.max(micros(F.col(ts))), start).alias("seen"))
        if due is None:
            out = rows.write.mode("overwrite").partitionBy("late")
            out.parquet(f"{folder}/out/batch={batch_id}")
        else:
            _leave(rows.filter("late").drop("late"), folder, "late", batch_id)
            on_time = rows.filter("NOT late").drop("late")
            held = _left(batch, folder, "held", batch_id, on_time.schema)
            waiting = held.unionByName(on_time)
            mark = newest.first()["seen"]
            reached = F.coalesce(due <= F.lit(mark) - delay_micros, F.lit(False))
            _leave(emit(waiting.filter(reached)), folder, "out", batch_id)
            _leave(waiting.filter(~reached), folder, "held", batch_id)
        _leave(newest, folder, "state", batch_id)
        rows.unpersist()
        _forget(batch, folder, batch_id, "state", "held")

    return write


def late_split_writer(
    folder: str,
    ts: str,
    order: Sequence[str],
    width_micros: int,
    delay_micros: int,
    lateness_micros: int = 0,
    marker: Column | None = None,
) -> Write:
    """Write each micro-batch's rows with their window and ``late`` flag, partitioned by it.

    The largest event time so far is carried from batch to batch, and rows move it one by one in
    arrival order, so the split is exact also within a batch.
    """

    def split(batch: DataFrame, start: Column) -> DataFrame:
        return late.late_rows(
            batch, ts, order, width_micros, delay_micros, lateness_micros, marker, start
        )

    return _marked_writer(folder, ts, marker, split)


def sorter_writer(
    folder: str, key: str, ts: str, order: Sequence[str], delay_micros: int
) -> Write:
    """The event sorter: rows in event-time order below ``out``, rows that came too late below
    ``late``.

    Lateness is exact per row, and only rows that are not late are held, until the watermark has
    passed them. What waits is what one delay brings.
    """

    def split(batch: DataFrame, start: Column) -> DataFrame:
        return late.sorter_rows(batch, ts, order, delay_micros, start)

    def emit(rows: DataFrame) -> DataFrame:
        return rows.orderBy(key, ts, *order)

    return _marked_writer(folder, ts, None, split, delay_micros, micros(F.col(ts)), emit)


def window_elements_writer(
    folder: str,
    key: str,
    ts: str,
    order: Sequence[str],
    width_micros: int,
    delay_micros: int,
) -> Write:
    """The elements of each window once it is closed, below ``out``; late rows below ``late``."""

    def split(batch: DataFrame, start: Column) -> DataFrame:
        return late.late_rows(batch, ts, order, width_micros, delay_micros, start=start)

    def emit(rows: DataFrame) -> DataFrame:
        return late.window_elements(rows, key, ts, order)

    due = micros(F.col("window_end")) - late.MILLI
    return _marked_writer(folder, ts, None, split, delay_micros, due, emit)


def dynamic_rule_writer(
    folder: str, is_control: Column, rule: Column, size: Column, order: Sequence[str]
) -> Write:
    """Filter rows by the newest rule that arrived before them, over all micro-batches.

    The newest rule of a batch is one row, carried to the next.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rules = batch.filter(F.coalesce(is_control, F.lit(False))).select(*order, rule.alias("rule"))
        before = _left(batch, folder, "state", batch_id, rules.schema)
        known: Row | None = before.first()
        start = F.lit(known["rule"]).cast(rules.schema["rule"].dataType) if known else None
        batch.persist()
        rows = control.dynamic_rule_filter(batch, is_control, rule, size, order, start)
        _leave(rows, folder, "out", batch_id)
        newest = rules.unionByName(before).agg(F.max(F.struct(*order, "rule")).alias("_r"))
        _leave(newest.filter("_r IS NOT NULL").select("_r.*"), folder, "state", batch_id)
        batch.unpersist()
        _forget(batch, folder, batch_id, "state")

    return write


def batched_writer(folder: str, order: Sequence[str], size: int) -> Write:
    """Hand rows over in numbered batches of ``size``, in arrival order over all micro-batches.

    Full batches go below ``out``. The open one goes below ``open``, under the micro-batch's
    number; the next micro-batch goes on filling it. :func:`read_batches` reads both.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        before = _left(batch, folder, "state", batch_id, "n long").first()
        n = before["n"] if before else 0
        numbered = sink_batches(batch, order, size, start=n)
        opened = _left(batch, folder, "open", batch_id, numbered.schema)
        n += batch.count()
        rows = opened.unionByName(numbered)
        full = F.col("batch_no") < n // size
        _leave(rows.filter(full), folder, "out", batch_id)
        _leave(rows.filter(~full), folder, "open", batch_id)
        counted = batch.sparkSession.range(1).select(F.lit(n).cast("long").alias("n"))
        _leave(counted, folder, "state", batch_id)
        batch.unpersist()
        _forget(batch, folder, batch_id, "state", "open")

    return write


def read_batches(rows: DataFrame, folder: str) -> DataFrame:
    """All rows that :func:`batched_writer` has handed over so far, with their batch_no.

    ``rows`` is a table like those that the writer gets."""
    spark = rows.sparkSession
    schema = sink_batches(rows.limit(0), rows.columns[:1], 1).schema
    names = [field.name for field in schema.fields]
    opened = spark.read.schema(schema.add("batch", "long")).parquet(f"{folder}/open")
    # the state has a row for each micro-batch, the open batch may have none
    last = spark.read.parquet(f"{folder}/state").agg(F.max("batch")).first()[0]
    full = spark.read.schema(schema).parquet(f"{folder}/out").select(*names)
    return full.unionByName(opened.filter(F.col("batch") == last).select(*names))


def changes_writer(folder: str) -> Write:
    """Write what changed in each micro-batch of a stream in update mode; see :func:`newest`."""

    def write(batch: DataFrame, batch_id: int) -> None:
        _leave(batch, folder, "out", batch_id)

    return write


def newest(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last state of each key from the changes and the ``batch`` they came in."""
    rest = [name for name in changes.columns if name not in (*keys, "batch")]
    last = changes.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("_last"))
    return last.select(*keys, "_last.*")
