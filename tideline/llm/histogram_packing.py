"""Best-fit packing planned on the histogram of lengths.

Best fit looks at lengths alone, so the plan is made from counts: at most ``capacity`` lengths
with their counts, whatever the corpus. Lengths are walked from the longest; the pieces of a
length go to the open sequences with the least room that still holds them, a whole group of like
sequences at a time, and then to new ones. This gives the same fill as best-fit decreasing piece
by piece. Each length splits at most two groups, so the plan has at most about three groups per
length, each with the few lengths that fit into it.

The plan says which ranks within a length go to which group. Pieces are numbered within their
length and joined to the plan on that rank; no piece passes through the driver.

Defined results: a null text counts as empty, and an empty document is one piece that holds only
the closing id; a null doc_id is kept as it is; repeated rows are documents of their own; an empty
table gives an empty result. Columns beyond doc_id and text play no part and may have any name.
"""

from __future__ import annotations

import bisect
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ranked, settled
from .tokens import CAPACITY, pieces

#: Columns of the plan: ranks [low, high) of a length go ``each`` at a time to the sequences
#: numbered from ``first``, behind ``offset`` tokens of longer pieces.
PLAN_SCHEMA = "length long, low long, high long, each long, first long, offset long"


@dataclass
class Group:
    """Sequences filled alike: how many, the room left, and (length, first rank, each) inside."""

    count: int
    room: int
    inside: list[tuple[int, int, int]] = field(default_factory=list)


class Rooms:
    """Groups by the room they have left, smallest room first."""

    def __init__(self) -> None:
        self.rooms: list[int] = []
        self.groups: dict[int, list[Group]] = {}
        self.full: list[Group] = []

    def add(self, group: Group) -> None:
        if not group.count:
            return
        if not group.room:
            self.full.append(group)
            return
        if group.room not in self.groups:
            bisect.insort(self.rooms, group.room)
            self.groups[group.room] = []
        self.groups[group.room].append(group)

    def best(self, length: int) -> Group | None:
        """Take out the group with the least room that holds the length."""
        at = bisect.bisect_left(self.rooms, length)
        if at == len(self.rooms):
            return None
        room = self.rooms[at]
        group = self.groups[room].pop()
        if not self.groups[room]:
            del self.groups[room], self.rooms[at]
        return group

    def all(self) -> list[Group]:
        return [*self.full, *(group for room in self.rooms for group in self.groups[room])]


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, ...]]:
    """The rows of the plan (see PLAN_SCHEMA) for the counts of each length."""
    rooms = Rooms()
    for length in sorted(histogram, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of {length} tokens does not fit into {capacity}")
        left, rank = histogram[length], 0
        while left:
            group = rooms.best(length)
            if group is None:
                # one group of new sequences takes all that is left
                group = Group(-(-left // (capacity // length)), capacity)
            each = group.room // length
            whole, rest = min(group.count, left // each), 0
            rooms.add(Group(whole, group.room - each * length, [*group.inside, (length, rank, each)]))
            rank += whole * each
            left -= whole * each
            if whole < group.count:
                # fewer pieces are left than one more sequence of this group holds
                rest = left
                if rest:
                    inside = [*_shifted(group.inside, whole), (length, rank, rest)]
                    rooms.add(Group(1, group.room - rest * length, inside))
                    rank += rest
                    left = 0
                skipped = whole + bool(rest)
                rooms.add(Group(group.count - skipped, group.room, _shifted(group.inside, skipped)))
    rows, first = [], 0
    for group in rooms.all():
        offset = 0
        for length, low, each in group.inside:
            rows.append((length, low, low + each * group.count, each, first, offset))
            offset += each * length
        first += group.count
    return rows


def _shifted(inside: list[tuple[int, int, int]], skipped: int) -> list[tuple[int, int, int]]:
    """What is inside the sequences of a group behind its first ``skipped`` ones."""
    return [(length, low + each * skipped, each) for length, low, each in inside]


def place(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to pieces that have a ``length`` (and doc_id and piece).

    ``parts`` is read several times: pass something settled.
    """
    spark = parts.sparkSession
    counts = parts.groupBy("length").count().collect()  # at most `capacity` rows
    rows = plan({row["length"]: row["count"] for row in counts}, capacity)
    slots = spark.createDataFrame(rows, PLAN_SCHEMA).select(
        F.struct("length", "low", "high", "each", "first", "offset").alias("_slot")
    )
    numbered = ranked(parts, ["length"], ["doc_id", "piece"], "_rank")
    here = (F.col("length") == F.col("_slot.length")) & (
        (F.col("_rank") >= F.col("_slot.low")) & (F.col("_rank") < F.col("_slot.high"))
    )
    # the plan's size depends on the capacity alone
    joined = numbered.join(F.broadcast(slots), here)
    step = F.col("_rank") - F.col("_slot.low")
    nth = F.expr("(_rank - _slot.low) div _slot.each")
    return joined.select(
        *parts.columns,
        (F.col("_slot.first") + nth).alias("sequence_id"),
        (F.col("_slot.offset") + (step - nth * F.col("_slot.each")) * F.col("length")).alias("offset"),
    )


def pack(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return place(settled(pieces(docs, doc_id, text, capacity)), capacity)


def pack_ids(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY
) -> DataFrame:
    """The same with the ids of each piece (binary, little-endian unsigned 32-bit)."""
    from .common import landed

    whole = landed(pieces(docs, doc_id, text, capacity, with_ids=True), "pieces")
    return place(whole, capacity)
