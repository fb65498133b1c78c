"""Aggregates that a user defines by four steps: create, add, merge, finish.

``add`` gets the values of a key that one Arrow batch holds, at once. Each task folds its batches
into one state per key; only these states are shuffled, first by key and a share of the tasks, then
by key. Both merges read their states in the order of the keys and hold one at a time, so a key of
any size costs its tasks one state each. Where a task meets more keys than ``held``, it hands over
what it has and starts anew.

A null key is a key like any other; null values are handed to ``add`` as nulls. An empty table
gives an empty result. Where Spark has the aggregate built in, use that.
"""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import IntegerType, StructType

from tideline.session import ship_by_value

ship_by_value(__name__)

#: Into how many shares the tasks' states of a key are dealt before they meet.
SHARES = 64
#: States that a task holds.
HELD = 100_000


class Accumulator(ABC):
    """``state`` names the parts of a state, ``result`` the type of what comes out (both DDL)."""

    state: str
    result: str

    @abstractmethod
    def create(self) -> tuple:
        """The state of no value."""

    @abstractmethod
    def add(self, state: tuple, values: pa.Array) -> tuple:
        """The state with some more values."""

    @abstractmethod
    def merge(self, one: tuple, other: tuple) -> tuple:
        """The state of the values of both, whichever comes first."""

    @abstractmethod
    def finish(self, state: tuple) -> object:
        """What comes out."""


class Average(Accumulator):
    """The mean of whole numbers, null without any."""

    state = "n long, total long"
    result = "double"

    def create(self):
        return 0, 0

    def add(self, state, values):
        return state[0] + len(values) - values.null_count, state[1] + (pc.sum(values).as_py() or 0)

    def merge(self, one, other):
        return one[0] + other[0], one[1] + other[1]

    def finish(self, state):
        return state[1] / state[0] if state[0] else None


class Quantile(Accumulator):
    """A quantile of whole numbers >= 0, rounded down to ``digits`` binary digits: the counts of
    the rounded values are the state, at most 2^(digits - 1) of them per power of two."""

    state = "places array<long>, counts array<long>"
    result = "long"

    def __init__(self, share: float, digits: int = 6):
        self.share, self.digits = share, digits

    def create(self):
        return [], []

    def add(self, state, values):
        counted = pc.value_counts(pc.drop_null(values))
        found = {}
        for value, n in zip(counted.field(0).to_pylist(), counted.field(1).to_pylist()):
            low = max(0, value.bit_length() - self.digits)
            place = value >> low << low
            found[place] = found.get(place, 0) + n
        return self.merge(state, (list(found), list(found.values())))

    def merge(self, one, other):
        total = dict(zip(*one))
        for place, n in zip(*other):
            total[place] = total.get(place, 0) + n
        places = sorted(total)
        return places, [total[place] for place in places]

    def finish(self, state):
        places, counts = state
        rank, seen = self.share * sum(counts), 0
        for place, n in zip(places, counts):
            seen += n
            if seen >= rank:
                return place
        return None


def accumulate(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    accumulator: Accumulator,
    name: str = "result",
    held: int = HELD,
) -> DataFrame:
    """One row per key: the keys and what the accumulator makes of its values."""
    inner = [f"_k{i}" for i in range(len(keys))]
    rows = df.select(*[F.col(key).alias(k) for key, k in zip(keys, inner)], F.col(value).alias("_value"))
    known = StructType([rows.schema[k] for k in inner])
    states = StructType([*known.fields]).add("_task", IntegerType())
    states = states.add("_state", StructType.fromDDL(accumulator.state))
    result = StructType.fromDDL(f"_result {accumulator.result}")
    out = StructType([*known.fields, *result.fields])

    partial = rows.mapInArrow(_folded(accumulator, inner, to_arrow_schema(states), held), states)
    share = F.pmod(F.col("_task"), F.lit(SHARES))
    some = (
        partial.repartition(*inner, share)
        .sortWithinPartitions(*inner)
        .mapInArrow(_merged(accumulator, inner, to_arrow_schema(states), False), states)
    )
    whole = (
        some.repartition(*inner)
        .sortWithinPartitions(*inner)
        .mapInArrow(_merged(accumulator, inner, to_arrow_schema(out), True), out)
    )
    return whole.select(
        *[F.col(k).alias(key) for key, k in zip(keys, inner)], F.col("_result").alias(name)
    )


def _rows(found: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*found) if found else [()] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(column), field.type) for column, field in zip(columns, schema)], schema=schema
    )


def _folded(accumulator: Accumulator, keys: list[str], schema: pa.Schema, held: int):
    """A task's states, one per key."""
    parts = [field.name for field in schema.field("_state").type]

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        states: dict[tuple, tuple] = {}

        def handed() -> pa.RecordBatch:
            found = [(*key, task, dict(zip(parts, state))) for key, state in states.items()]
            states.clear()
            return _rows(found, schema)

        for batch in batches:
            grouped = pa.Table.from_batches([batch]).group_by(keys).aggregate([("_value", "list")])
            lists = grouped.column("_value_list").combine_chunks()
            for i, key in enumerate(zip(*[grouped.column(k).to_pylist() for k in keys])):
                before = states.get(key)
                before = accumulator.create() if before is None else before
                states[key] = accumulator.add(before, lists[i].values)
            if len(states) >= held:
                yield handed()
        yield handed()

    return fold


def _merged(accumulator: Accumulator, keys: list[str], schema: pa.Schema, last: bool):
    """One state per key, or at last one result, of states that come in the order of the keys."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state, task, parts = None, None, 0, ()

        def handed() -> tuple:
            if last:
                return (*current, accumulator.finish(state))
            return (*current, task, dict(zip(parts, state)))

        for batch in batches:
            found = []
            parts = [field.name for field in batch.schema.field("_state").type]
            columns = [batch.column(k).to_pylist() for k in (*keys, "_task", "_state")]
            for *key, number, given in zip(*columns):
                more = tuple(given[part] for part in parts)
                if state is not None and key == current:
                    state = accumulator.merge(state, more)
                    continue
                if state is not None:
                    found.append(handed())
                current, state, task = key, more, number
            yield _rows(found, schema)
        if state is not None:
            yield _rows([handed()], schema)

    return merge
