"""Packed id matrices by best-fit decreasing, with a segment tree over the room left.

Each task encodes its documents, cuts those longer than a sequence without loss, and packs about
``BUFFER`` tokens at a time: pieces from the longest to the shortest, each into the open sequence
with the least room that holds it. The tree has a leaf for each amount of room and finds that
sequence in log2(capacity) steps. Nothing is shuffled; memory follows the buffer, not the table.
A buffer holds thousands of sequences, so little room is lost where buffers meet. Partitions too narrow
for a buffer are read together by one task, after a pass that adds up the lengths of the texts.

Rows are matrix rows: ids (little-endian, two bytes while the vocabulary allows), the cumulative
lengths of the segments, and the places where positions start again from 0.

Defined results: a null text counts as empty and an empty document is one segment that holds only
the closing id; a null doc_id is listed as it is; repeated rows are documents of their own; an
empty table gives an empty result. Columns beyond doc_id and text play no part.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_by_value
from .tokens import CAPACITY, VOCABULARY, cut_points, document_ids

ship_by_value(__name__)

#: Tokens that a task packs at a time.
BUFFER = 4 << 20
#: Characters that are expected to give a token.
CHARS = 4
#: Fills what is left of a sequence.
PAD_ID = 0
#: Bits of a sequence's number within its task.
NUMBER_BITS = 33


class RoomTree:
    """Open sequences by room: the one with the least room that is enough, in logarithmic time."""

    def __init__(self, capacity: int) -> None:
        self.size = 1 << int(capacity).bit_length()
        self.counts = [0] * (2 * self.size)
        self.open: list[list[int]] = [[] for _ in range(self.size)]

    def add(self, room: int, sequence: int) -> None:
        self.open[room].append(sequence)
        self._change(room, 1)

    def take(self, least: int) -> tuple[int, int] | None:
        """Remove and return (room, sequence) for the least room >= ``least``."""
        node = least + self.size
        if not self.counts[node]:
            # up to the first subtree on the right that is not empty, then down its left side
            while node > 1 and (node & 1 or not self.counts[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node = 2 * node if self.counts[2 * node] else 2 * node + 1
        room = node - self.size
        self._change(room, -1)
        return room, self.open[room].pop()

    def _change(self, room: int, by: int) -> None:
        node = room + self.size
        while node:
            self.counts[node] += by
            node >>= 1


def best_fit_decreasing(lengths: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Sequences as lists of places in ``lengths``, each adding up to at most ``capacity``."""
    tree, sequences = RoomTree(capacity), []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        best = tree.take(lengths[i])
        if best is None:
            best = capacity, len(sequences)
            sequences.append([])
        room, sequence = best
        sequences[sequence].append(i)
        if room > lengths[i]:
            tree.add(room - lengths[i], sequence)
    return sequences


def positions(cumulative: list[int]) -> np.ndarray:
    """Position ids of a sequence: from 0 in each segment."""
    lengths = np.diff(cumulative)
    return np.arange(cumulative[-1]) - np.repeat(cumulative[:-1], lengths)


def pack_matrix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    vocabulary: str = VOCABULARY,
    buffer: int = BUFFER,
    wide: bool = False,
) -> DataFrame:
    """One row per sequence: sequence_id, n_tokens, ids (``capacity`` ids, padded), ids_crc32 (of
    the ids without padding), cumulative (segment lengths, from 0), resets (where positions start
    again), doc_ids and starts (of each segment). ``wide`` gives four bytes per id."""
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    # narrow pieces together, so that a task has a full buffer; every document has a closing id
    amount = narrow.agg(F.sum(F.coalesce(F.length("text"), F.lit(0)) + 1)).first()[0] or 0
    narrow = narrow.coalesce(max(1, amount // (CHARS * buffer)))
    id_type = "<u4" if wide else "<u2"
    kind = narrow.schema["doc_id"].dataType
    schema = T.StructType(
        [
            T.StructField("sequence_id", T.LongType()),
            T.StructField("n_tokens", T.IntegerType()),
            T.StructField("ids", T.BinaryType()),
            T.StructField("ids_crc32", T.LongType()),
            T.StructField("cumulative", T.ArrayType(T.IntegerType())),
            T.StructField("resets", T.ArrayType(T.IntegerType())),
            T.StructField("doc_ids", T.ArrayType(kind)),
            T.StructField("starts", T.ArrayType(T.LongType())),
        ]
    )

    def packed(held: list[tuple], first: int, id_kind: pa.DataType) -> Iterator[pa.RecordBatch]:
        sequences = best_fit_decreasing([len(ids) for _, _, ids in held], capacity)
        for low in range(0, len(sequences), 512):
            columns: list[list] = [[] for _ in schema.names]
            for number, members in enumerate(sequences[low : low + 512], first + low):
                ids = np.concatenate([held[i][2] for i in members])
                row = np.full(capacity, PAD_ID, id_type)
                row[: len(ids)] = ids
                bounds = np.cumsum([0, *(len(held[i][2]) for i in members)]).astype(np.int32)
                values = (
                    number,
                    len(ids),
                    row.tobytes(),
                    zlib.crc32(ids.astype("<u4").tobytes()),
                    bounds,
                    bounds[:-1],
                    [held[i][0] for i in members],
                    [held[i][1] for i in members],
                )
                for column, value in zip(columns, values):
                    column.append(value)
            kinds = [
                pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.list_(pa.int32()),
                pa.list_(pa.int32()), pa.list_(id_kind), pa.list_(pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(columns, kinds)], names=schema.names
            )
        counter[0] = first + len(sequences)

    counter = [0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter[0] = TaskContext.get().partitionId() << NUMBER_BITS
        held, tokens, id_kind = [], 0, pa.int64()
        for batch in batches:
            names, id_kind = batch.column("doc_id"), batch.schema.field("doc_id").type
            for row, value in enumerate(batch.column("text")):
                ids = document_ids(value.as_py(), vocabulary).astype(id_type)
                begins = cut_points(len(ids), capacity)
                name = names[row].as_py()
                held += [
                    (name, begin, ids[begin:end])
                    for begin, end in zip(begins, [*begins[1:], len(ids)])
                ]
                tokens += len(ids)
                if tokens >= buffer:
                    yield from packed(held, counter[0], id_kind)
                    held, tokens = [], 0
        if held:
            yield from packed(held, counter[0], id_kind)

    return narrow.mapInArrow(run, schema)


def write_matrix(packed: DataFrame, path: str) -> None:
    """Write the matrix rows as Parquet: fixed-length binary ids and the segment columns."""
    packed.write.parquet(path)
