"""Windows that a user's trigger closes: a small automaton per key, run over the rows in order.

A trigger has a few states and, for each kind of row, what follows each state and whether the
window closes with this row. Such steps compose: what a stretch of rows does is a table with an
entry per state. Rows are dealt by ranges of key and order, so a hot key spans many tasks; each task
reduces its stretch of a key to that table, the tables of a key are composed in order, and each
task runs the automaton from the state that the stretches before it leave. Only a partition's first
key can have begun earlier, so there are no more such states than partitions, and they are
broadcast.

A null key is a key like any other; a null symbol changes nothing and closes nothing. An empty table
gives an empty result. ``order`` should tell the rows of a key apart; rows that tie come in any order.
The rows are checkpointed as they are dealt: pass narrow ones.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tideline.session import settled, ship_by_value

ship_by_value(__name__)


@dataclass(frozen=True)
class Trigger:
    """``after[symbol][state]`` is the next state, ``closes[symbol][state]`` whether the window
    closes with the row. State 0 is the first."""

    after: Sequence[Sequence[int]]
    closes: Sequence[Sequence[bool]]

    def steps(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each row (-1: null) the next state and whether it closes, per state."""
        states = len(self.after[0])
        after = np.vstack([np.asarray(self.after), np.arange(states)])
        closes = np.vstack([np.asarray(self.closes, bool), np.zeros(states, bool)])
        return after[symbols], closes[symbols]


def count_or_stop(size: int) -> Trigger:
    """Closes with every ``size``-th row since it last closed, and with each row of symbol 1."""
    last = size - 1
    counted = [(state + 1) % size for state in range(size)]
    return Trigger([counted, [0] * size], [[state == last for state in range(size)], [True] * size])


def prefixes(after: np.ndarray) -> np.ndarray:
    """What the first 1, 2, ... rows do together, per state: composed by doubling."""
    done, step = after.copy(), 1
    while step < len(done):
        done[step:] = np.take_along_axis(done[step:], done[:-step], axis=1)
        step *= 2
    return done


def windows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    symbol: Column,
    trigger: Trigger,
    number: str = "window_no",
    closes: str = "closes",
) -> DataFrame:
    """The rows with the number of their window in its key, from 0, and whether they close it."""
    names = [f"_k{i}" for i in range(len(keys))]
    rows = df.select(
        F.struct(*[df[f"`{name}`"] for name in df.columns]).alias("_row"),
        *[F.col(key).alias(name) for key, name in zip(keys, names)],
        F.struct(*[F.col(name) for name in order]).alias("_order"),
        F.coalesce(symbol.cast("int"), F.lit(-1)).alias("_symbol"),
    )
    placed = settled(
        rows.repartitionByRange(*names, "_order")
        .sortWithinPartitions(*names, "_order")
        .withColumn("_part", F.spark_partition_id())
        .drop("_order")
    )
    known = [placed.schema[name] for name in (*names, "_part")]
    parts = StructType([*known, *StructType.fromDDL("_ends array<int>, _closed array<long>").fields])
    starts = StructType([*known, *StructType.fromDDL("_start int, _before long").fields])
    reduced = placed.select(*names, "_symbol", "_part").mapInArrow(
        _reduced(trigger, names, to_arrow_schema(parts)), parts
    )
    left = (
        reduced.repartition(*names)
        .sortWithinPartitions(*names, "_part")
        .mapInArrow(_starts(names, to_arrow_schema(starts)), starts)
    )
    here = F.struct(*names, "_part")
    known_left = left.select(F.struct(*names, "_part").alias("_at"), "_start", "_before")
    met = placed.join(F.broadcast(settled(known_left)), here.eqNullSafe(F.col("_at")), "left")
    out = StructType([placed.schema["_row"], *StructType.fromDDL("_no long, _closes boolean").fields])
    run = met.select("_row", *names, "_symbol", "_start", "_before")
    found = run.mapInArrow(_numbered(trigger, names, to_arrow_schema(out)), out)
    return found.select("_row.*", F.col("_no").alias(number), F.col("_closes").alias(closes))


def _runs(batch: pa.RecordBatch, names: list[str]) -> list[tuple[tuple, int, int]]:
    """The stretches of equal keys of a batch in the order of its keys: key, begin, end."""
    changed = np.zeros(batch.num_rows, bool)
    changed[:1] = True
    for name in names:
        codes = batch.column(name).dictionary_encode(null_encoding="encode").indices.to_numpy()
        changed[1:] |= codes[1:] != codes[:-1]
    begins = np.flatnonzero(changed)
    ends = np.append(begins[1:], batch.num_rows)
    heads = zip(*[batch.column(name).take(pa.array(begins)).to_pylist() for name in names])
    return [(key, int(a), int(b)) for key, a, b in zip(heads, begins, ends)]


def _batch(found: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*found) if found else [()] * len(schema)
    arrays = [pa.array(list(column), field.type) for column, field in zip(columns, schema)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _reduced(trigger: Trigger, names: list[str], schema: pa.Schema):
    """What each key's stretch in this partition does, per state it may begin in."""

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states = np.arange(len(trigger.after[0]))
        current, part, ends, closed = None, 0, states, np.zeros(len(states), int)
        for batch in batches:
            found = []
            after, closes = trigger.steps(batch.column("_symbol").to_numpy())
            for key, a, b in _runs(batch, names):
                if key != current:
                    if current is not None:
                        found.append((*current, part, ends.tolist(), closed.tolist()))
                    current, part = key, batch.column("_part")[a].as_py()
                    ends, closed = states, np.zeros(len(states), int)
                done = prefixes(after[a:b])
                before = np.vstack([states, done[:-1]])
                count = np.take_along_axis(closes[a:b], before, axis=1).sum(axis=0)
                closed = closed + count[ends]
                ends = done[-1][ends]
            yield _batch(found, schema)
        if current is not None:
            yield _batch([(*current, part, ends.tolist(), closed.tolist())], schema)

    return reduce


def _starts(names: list[str], schema: pa.Schema):
    """The state in which each stretch but a key's first begins, and the windows closed by then."""

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state, closed = None, 0, 0
        for batch in batches:
            found = []
            columns = [batch.column(name).to_pylist() for name in (*names, "_part", "_ends", "_closed")]
            for *key, part, ends, counts in zip(*columns):
                if key == current:
                    found.append((*key, part, state, closed))
                else:
                    current, state, closed = key, 0, 0
                state, closed = ends[state], closed + counts[state]
            yield _batch(found, schema)

    return compose


def _numbered(trigger: Trigger, names: list[str], schema: pa.Schema):
    """The rows of a partition with their windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state, before = None, 0, 0
        for batch in batches:
            after, closes = trigger.steps(batch.column("_symbol").to_numpy())
            numbers = np.empty(batch.num_rows, np.int64)
            closing = np.empty(batch.num_rows, bool)
            for key, a, b in _runs(batch, names):
                if key != current:
                    current = key
                    state = batch.column("_start")[a].as_py() or 0
                    before = batch.column("_before")[a].as_py() or 0
                done = prefixes(after[a:b])[:, state]
                at = np.concatenate([[state], done[:-1]])
                closing[a:b] = closes[np.arange(a, b), at]
                closed = before + np.cumsum(closing[a:b])
                numbers[a:b] = closed - closing[a:b]
                state, before = int(done[-1]), int(closed[-1])
            columns = [batch.column("_row"), pa.array(numbers), pa.array(closing)]
            yield pa.RecordBatch.from_arrays(
                [column.cast(field.type) for column, field in zip(columns, schema)], schema=schema
            )

    return run
