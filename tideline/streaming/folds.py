"""Keyed state for keys of any size: each micro-batch is folded by the batch operators.

What earlier micro-batches left of a key is one row (or one per open window), which takes part in
the next one as a row that came before. So a key's rows are folded in parallel chunks, as in batch,
and only a summary per key goes from micro-batch to micro-batch. No task and no worker ever holds
what one key brings. The writers are for ``foreachBatch``; state and results lie below the folder
under the micro-batch's number, so that one that is run again replaces what it wrote.

The state is written anew by each micro-batch: take ones that are large against the number of keys
(for many small ones the processors of ``forms`` keep state per key). The arrival columns must grow
from micro-batch to micro-batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.operators import control, pairing
from tideline.operators.running import Fold, running
from tideline.operators.skew import HOT_ROWS
from tideline.streaming.batches import Write, _forget, _leave, _left

OLD = "_old"


def _with_old(rows: DataFrame, folder: str, batch_id: int) -> DataFrame:
    """The micro-batch's rows and, marked, those that the one before has left."""
    before = _left(rows, folder, "state", batch_id, rows.schema)
    old = before.withColumn(OLD, F.lit(True))
    return old.unionByName(rows.withColumn(OLD, F.lit(False)))


def _last_rows(rows: DataFrame, key: str, order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The last row of each key; a null key is a key."""
    stamp = F.struct(*order, OLD)
    last = rows.groupBy(key).agg(F.max_by(F.struct(*order, *columns), stamp).alias("_last"))
    return last.select(key, "_last.*")


def _kind(rows: DataFrame, value: str) -> T.DataType:
    """Sums of whole numbers stay whole, all others become doubles."""
    whole = isinstance(rows.schema[value].dataType, T.IntegralType)
    return T.LongType() if whole else T.DoubleType()


def running_writer(
    folder: str,
    key: str,
    order: Sequence[str],
    value: str,
    with_text: bool = False,
    hot_rows: int = HOT_ROWS,
) -> Write:
    """Per row, the sum of its key so far (``total``) and, on request, the text of its values."""

    def write(batch: DataFrame, batch_id: int) -> None:
        text = F.col(value).cast("string") if with_text else F.lit(None).cast("string")
        number = F.col(value).cast(_kind(batch, value))
        rows = batch.select(key, *order, number.alias("total"), text.alias("text"))
        folds = {"sum": Fold("sum", F.col("total"))}
        if with_text:
            folds["texts"] = Fold("text", F.col("text"), sep=" and ")
        found = running(_with_old(rows, folder, batch_id), [key], order, folds, hot_rows=hot_rows)
        texts = F.col("texts") if with_text else F.col("text")
        found = found.select(key, *order, OLD, F.col("sum").alias("total"), texts.alias("text")).persist()
        said = F.concat(F.lit("Contains: "), F.col("text"))
        _leave(found.filter(f"NOT {OLD}").drop(OLD).withColumn("text", said), folder, "out", batch_id)
        _leave(_last_rows(found, key, order, ["total", "text"]), folder, "state", batch_id)
        found.unpersist()
        _forget(batch, folder, batch_id, "state")

    return write


def counted_writer(
    folder: str,
    key: str,
    order: Sequence[str],
    value: str,
    every: int,
    size: int | None = None,
    hot_rows: int = HOT_ROWS,
) -> Write:
    """At each ``every``-th row of a key (``rn``), the sum (``total``) and the number (``given``) of
    the values of all its rows so far, or of the last ``size`` rows (fewer at the start)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        number = F.col(value).cast(_kind(batch, value))
        one = F.lit(1).cast("long")
        there = F.col(value).isNotNull().cast("long")
        rows = batch.select(key, *order, one.alias("n"), number.alias("total"), there.alias("given"))
        folds = {"rn": Fold("sum", F.col("n"))}
        if size is None:
            folds |= {"sum": Fold("sum", F.col("total")), "some": Fold("sum", F.col("given"))}
        found = running(_with_old(rows, folder, batch_id), [key], order, folds, hot_rows=hot_rows).persist()
        new = found.filter(f"NOT {OLD}")
        sums = ["n", "total", "given"]
        if size is None:
            fired = new.filter(F.col("rn") % every == 0)
            out = fired.select(key, "rn", F.col("sum").alias("total"), F.col("some").alias("given"))
            left = found.select(key, *order, OLD, F.col("rn").alias("n"), F.col("sum").alias("total"),
                                F.col("some").alias("given"))
        else:
            windows = _windows(new, key, every, size)
            before = _left(batch, folder, "open", batch_id, windows.schema)
            merged = windows.unionByName(before).groupBy(key, "fire").agg(
                F.sum("total").alias("total"), F.sum("given").alias("given"), F.max("last").alias("last")
            ).persist()
            out = merged.filter("last = fire").select(key, F.col("fire").alias("rn"), "total", "given")
            _leave(merged.filter("last < fire"), folder, "open", batch_id)
            nothing = F.lit(None).cast(_kind(batch, value)).alias("total")
            left = found.select(key, *order, OLD, F.col("rn").alias("n"), nothing, F.lit(0).cast("long").alias("given"))
        _leave(out, folder, "out", batch_id)
        _leave(_last_rows(left, key, order, sums), folder, "state", batch_id)
        found.unpersist()
        if size is not None:
            merged.unpersist()
        _forget(batch, folder, batch_id, "state", "open")

    return write


def _windows(rows: DataFrame, key: str, every: int, size: int) -> DataFrame:
    """Parts of the windows that fire at each ``every``-th row, of the last ``size`` rows."""
    first = F.ceil(F.col("rn") / every).cast("long") * every
    last = F.col("rn") + (size - 1)
    fires = F.when(first <= last, F.sequence(first, last, F.lit(every).cast("long")))
    spread = rows.select(key, "rn", "total", "given", F.explode(fires).alias("fire"))
    return spread.groupBy(key, "fire").agg(
        F.sum("total").alias("total"), F.sum("given").alias("given"), F.max("rn").alias("last")
    )


def blocklist_writer(folder: str, is_control: Column, on: str, seq: str) -> Write:
    """Rows pass until a control row of their key has arrived. A row without key always passes."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        named = F.coalesce(is_control, F.lit(False))
        controls = batch.filter(named).select(on, seq)
        before = _left(batch, folder, "state", batch_id, controls.schema)
        known = before.unionByName(controls).filter(F.col(on).isNotNull())
        first = known.groupBy(on).agg(F.min(seq).alias(seq)).persist()
        _leave(control.blocklist_ordered(batch.filter(~named), first, on, seq), folder, "out", batch_id)
        _leave(first, folder, "state", batch_id)
        first.unpersist()
        batch.unpersist()
        _forget(batch, folder, batch_id, "state")

    return write


def slots_writer(
    folder: str, key: str, seq: str, is_left: str, payload: str, hot_rows: int = HOT_ROWS
) -> Write:
    """Pairs with one saved row per side. What a key leaves is its last row, unless that made a pair."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(key, seq, is_left, payload)
        before = _left(batch, folder, "state", batch_id, rows.schema)
        rows = before.unionByName(rows).persist()
        pairs = pairing.pair_slots(rows, key, seq, is_left, payload, hot_rows).persist()
        _leave(pairs, folder, "out", batch_id)
        last = rows.groupBy(key).agg(F.max(F.struct(seq, is_left, payload)).alias("_last"))
        last = last.select(F.struct(key, f"_last.{seq}").alias("_at"), key, "_last.*")
        made = pairs.select(F.struct(key, seq).alias("_at"))
        _leave(last.join(made, "_at", "left_anti").drop("_at"), folder, "state", batch_id)
        pairs.unpersist()
        rows.unpersist()
        _forget(batch, folder, batch_id, "state")

    return write


def rules_writer(
    folder: str,
    is_control: Column,
    name: str,
    rule: Column,
    size: Column,
    order: Sequence[str],
    hot_rows: int = HOT_ROWS,
) -> Write:
    """Filter rows by the newest rule of their name; see :func:`control.rules_asof`. The rules in force,
    one row per name, go from micro-batch to micro-batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        named = F.coalesce(is_control, F.lit(False))
        data = [c for c in batch.columns if c not in (name, *order)]
        rows = batch.withColumns({"_control": named, "_rule": F.when(named, rule), "_size": size})
        rules = rows.filter("_control").select(name, *order, "_rule")
        before = _left(batch, folder, "state", batch_id, rules.schema)
        old = before.withColumn("_control", F.lit(True))
        rows = old.unionByName(rows, allowMissingColumns=True).persist()
        passed = control.rules_asof(
            rows, F.col("_control"), name, F.col("_rule"), F.col("_size"), order, hot_rows
        )
        _leave(passed.select(name, *order, *data, "rule"), folder, "out", batch_id)
        newest = F.max_by(F.struct(*order, "_rule"), F.struct(*order)).alias("_last")
        known = rows.filter("_control").filter(F.col(name).isNotNull()).groupBy(name).agg(newest)
        _leave(known.select(name, "_last.*"), folder, "state", batch_id)
        rows.unpersist()
        _forget(batch, folder, batch_id, "state")

    return write


def matched_writer(
    folder: str, is_left: str, on: str, left: Sequence[str], right: Sequence[str], once: bool = False
) -> Write:
    """Join rows of two sides that share ``on``, whichever comes first; each right row has one left
    row, and is forgotten as soon as it has met it. Right rows that wait are carried on, left rows
    are kept, or forgotten with their first match if ``once``: then a key has one row of either side.

    Nothing is bounded by time: what is kept are the left rows (each written once) and the right
    rows that still wait.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        came = batch.filter(F.col(is_left)).select(on, *left)
        rows = batch.filter(~F.col(is_left)).select(on, *right)
        waiting = _left(batch, folder, "waiting", batch_id, rows.schema).unionByName(rows)
        if once:
            known = _left(batch, folder, "left", batch_id, came.schema).unionByName(came)
        elif batch_id == 0:
            known = came
        else:
            # each micro-batch adds its left rows; one that is run again must not see its own
            kept = spark.read.schema(came.schema.add("batch", "long")).parquet(f"{folder}/left")
            known = kept.filter(F.col("batch") < batch_id).drop("batch").unionByName(came)
        _leave(waiting.join(known, on), folder, "out", batch_id)
        _leave(waiting.join(known.select(on), on, "left_anti"), folder, "waiting", batch_id)
        if once:
            _leave(known.join(waiting.select(on), on, "left_anti"), folder, "left", batch_id)
            _forget(batch, folder, batch_id, "left")
        else:
            _leave(came, folder, "left", batch_id)
        batch.unpersist()
        _forget(batch, folder, batch_id, "waiting")

    return write
