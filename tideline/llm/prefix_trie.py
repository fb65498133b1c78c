"""The trie of the prefixes of all conversations, in balanced-parentheses shards.

A conversation is a sequence of turns (role, text); each distinct sequence of its first d turns
is a node of depth d. Nodes are named by a digest of their turns, which is folded along each
conversation, so a conversation of any length is never held whole. A node of one conversation has
a chain below it that nothing else shares and is described by its rows alone. All other nodes lie
on the shared paths of conversations. These are dealt by range of (path, conversation) to shards.

A shard writes its paths as one sequence of balanced parentheses: a node's subtree lies between
its parenthesis and the matching one (``findclose``), which is found by skipping blocks whose least
excess stays above the node's. Leaf pairs "()" inside are counted by rank, savings by differences of a
cumulative array. The chain of a single conversation is one leaf pair.

A path at the edge of a shard goes on in the next one, so the nodes of a shard's first and last
path (its spines) may be known in part only. Their parts are merged by node. What was counted
once per shard and not once is taken back for the node and all its ancestors: in depth-first order
a subtree is an interval, so this is a difference of running sums over the merged spines.

Defined results: turns are ordered by turn, null first, and equal ones by the digest of role and
text; a null role or text is empty; rows without conv_id belong to no conversation and are left
out; of an empty table nothing comes out, not even a root. Columns beyond these four play no part
and may have any name. Repeated rows are turns like any other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.running import Fold, chunk_levels, running
from ..operators.skew import HOT_ROWS
from ..session import settled, ship_by_value
from .common import join_groups, landed, ranked

ship_by_value(__name__)

#: Conversations of a family share the first turns of its first member.
FAMILY = 100
#: The number of shared turns is the CRC-32 of conv_id modulo this.
SHARED = 6
#: Parentheses of a block of the excess index.
BLOCK = 512
#: Bytes of a piece of a list of members that is hashed across shards.
PIECE = 1 << 20
#: Shards (2 to this) of a chunk of spines.
SHARD_BITS = 6
#: The digest of nobody.
NOBODY = hashlib.sha256(b"").hexdigest()


def turns(rows: DataFrame) -> DataFrame:
    """(conv_id, pos, turn_key, points): the turns of each conversation, numbered from 0."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    narrow = settled(
        rows.where("conv_id is not null").select(
            F.col("conv_id").cast("long").alias("conv_id"),
            F.col("turn").isNotNull().alias("has_turn"),
            "turn",
            F.md5(F.concat(F.length(role), F.lit(":"), role, text)).alias("turn_key"),
            F.length(text).cast("long").alias("points"),
        )
    )
    numbered = ranked(narrow, ["conv_id"], ["has_turn", "turn", "turn_key"], "pos")
    return numbered.select("conv_id", "pos", "turn_key", "points")


def rebuilt(known: DataFrame, family: int = FAMILY, shared: int = SHARED) -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations: (conv_id, depth, turn_key, points) from depth 1, and (conv_id,
    total), which also has those without turns. ``known`` is a settled table of turns."""
    sizes = settled(known.groupBy("conv_id").agg(F.count("*").alias("size")))
    base = F.col("conv_id") - F.col("conv_id") % family
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % shared
    bases = sizes.select(F.col("conv_id").alias("base"), F.col("size").alias("base_size"))
    plans = sizes.withColumns({"base": base, "head": head}).join(bases, "base", "left")
    plans = settled(
        plans.withColumn("taken", F.least("head", F.coalesce("base_size", F.lit(0)))).select(
            "conv_id", "base", "size", "head", "taken"
        )
    )
    own = join_groups(known, plans, "conv_id", "size").where("pos >= head")
    own = own.select(
        "conv_id", (F.col("pos") - F.col("head") + F.col("taken") + 1).alias("depth"), "turn_key", "points"
    )
    # a base gives few turns to at most two families of conversations
    given = known.where((F.col("pos") < shared) & (F.col("conv_id") % family == 0))
    given = given.select(F.col("conv_id").alias("base"), "pos", "turn_key", "points")
    first = plans.where("taken > 0").join(given, "base").where("pos < taken")
    first = first.select("conv_id", (F.col("pos") + 1).alias("depth"), "turn_key", "points")
    totals = plans.select(
        "conv_id", (F.col("taken") + F.greatest(F.col("size") - F.col("head"), F.lit(0))).alias("total")
    )
    return first.unionByName(own), totals


def prefixes(steps: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add ``node``, the name of each row's prefix: 128 bits that depend on all turns up to it.

    Each turn at its depth draws four numbers below 2^31; their running sums name the prefix.
    """
    draws = {
        f"s{i}": Fold("sum", F.xxhash64("turn_key", "depth", F.lit(i)).bitwiseAND(F.lit(0x7FFFFFFF)))
        for i in range(4)
    }
    summed = running(steps, ["conv_id"], ["depth"], draws, hot_rows=hot_rows)
    name = F.unhex(F.md5(F.concat_ws(",", "depth", *draws)))
    return summed.withColumn("node", name).drop(*draws)


class Parentheses:
    """A sequence of balanced parentheses with its excess, the least excess of each block, and
    the number of leaf pairs before each place."""

    def __init__(self, opens: np.ndarray, block: int = BLOCK):
        self.opens, self.block = opens, block
        self.excess = np.cumsum(np.where(opens, 1, -1))
        self.leaves = np.zeros(len(opens) + 1, np.int64)
        pair = opens[:-1] & ~opens[1:]
        self.leaves[1 : len(pair) + 1] = np.cumsum(pair)
        self.leaves[len(pair) + 1 :] = self.leaves[len(pair)]
        starts = np.arange(0, len(opens), block)
        self.least = np.minimum.reduceat(self.excess, starts) if len(opens) else self.excess

    def findclose(self, at: np.ndarray) -> np.ndarray:
        """The place of the parenthesis that closes each of those at ``at``: the first behind it
        with less excess. Blocks whose least excess is no less are skipped."""
        found = np.full(len(at), -1, np.int64)
        goal = self.excess[at] - 1
        # the rest of the own block, then block after block, all places at once
        block = at // self.block
        todo = np.arange(len(at))
        begin = at + 1
        while len(todo):
            ends = np.minimum((block + 1) * self.block, len(self.opens))
            offset = np.arange(self.block)
            for low in range(0, len(todo), 4096):
                some = todo[low : low + 4096]
                places = begin[low : low + 4096, None] + offset
                inside = places < ends[low : low + 4096, None]
                hit = inside & (self.excess[np.where(inside, places, 0)] == goal[some][:, None])
                has = hit.any(axis=1)
                found[some[has]] = begin[low : low + 4096][has] + hit[has].argmax(axis=1)
            left = found[todo] < 0
            todo, block = todo[left], block[left]
            block = self._next_block(block, goal[todo])
            begin = block * self.block
        return found

    def _next_block(self, block: np.ndarray, goal: np.ndarray) -> np.ndarray:
        """The next block that gets as low as the goal, by doubling over least values."""
        levels = self._levels()
        block = block + 1
        # up while whole runs of blocks stay above the goal, then down again
        for step in [*range(len(levels)), *range(len(levels) - 1, -1, -1)]:
            run = levels[step]
            skip = (block < len(run)) & (run[np.minimum(block, len(run) - 1)] > goal)
            block = np.where(skip, block + (1 << step), block)
        return block

    def _levels(self) -> list[np.ndarray]:
        """Least excess of runs of 1, 2, 4, ... blocks from each block on."""
        if not hasattr(self, "_runs"):
            runs, width = [self.least], 1
            while width < len(self.least):
                last = runs[-1]
                far = np.append(last[width:], np.full(min(width, len(last)), last[-1]))
                runs.append(np.minimum(last, far))
                width *= 2
            self._runs = runs
        return self._runs


@dataclass
class Trie:
    """The trie of a shard's sorted paths. For each parenthesis, whether it opens and the number of
    the path that wrote it; for each node, in depth-first order, its parenthesis, depth and
    parent (-1: none); for each path, its last node."""

    opens: np.ndarray
    owner: np.ndarray
    place: np.ndarray
    depth: np.ndarray
    parent: np.ndarray
    last: np.ndarray


def shard_trie(paths: Sequence[Sequence[bytes]], tails: Sequence[bool]) -> Trie:
    """``tails`` says which paths go on in a chain of their own, written as one leaf pair."""
    opens: list[bool] = []
    owner: list[int] = []
    place: list[int] = []
    depth: list[int] = []
    parent: list[int] = []
    last: list[int] = []
    stack: list[int] = []
    before: Sequence[bytes] = ()
    for i, path in enumerate(paths):
        same = 0
        for mine, other in zip(path, before):
            if mine != other:
                break
            same += 1
        closed = len(stack) - same
        opens += [False] * closed
        del stack[same:]
        for d in range(same, len(path)):
            parent.append(stack[-1] if stack else -1)
            stack.append(len(place))
            place.append(len(opens))
            depth.append(d)
            opens.append(True)
        last.append(stack[-1])
        if tails[i]:
            opens += [True, False]
        owner += [i] * (len(opens) - len(owner))
        before = path
    opens += [False] * len(stack)
    owner += [len(paths)] * len(stack)
    whole = [np.array(numbers, np.int64) for numbers in (owner, place, depth, parent, last)]
    return Trie(np.array(opens, bool), *whole)


#: What a shard says of a node: counts inside the shard, and the conversations that end there, as a
#: digest or, on a spine, as pieces of their list.
PARTS = (
    "shard long, spine boolean, node binary, parent binary, depth long, conv_id long, "
    "parent_conv_id long, n_convs long, saved_here long, members long, children long, leaves long, "
    "saved long, leaf boolean, ends_sha256 string, ends string, piece long"
)
PART_NAMES = [field.split(" ")[0] for field in PARTS.split(", ")]


def _member_pieces(names: np.ndarray) -> list[str | None]:
    """Numbers joined by commas, in pieces of bounded length; at least one piece, which may be null."""
    step = PIECE // 21
    joined = [",".join(map(str, names[k : k + step].tolist())) for k in range(0, len(names), step)]
    return joined or [None]


def _digest(names: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, names.tolist())).encode()).hexdigest()


def shard_nodes(shard: int, rows: list[dict], block: int = BLOCK) -> Iterator[pa.RecordBatch]:
    """The nodes of a shard, from its rows in order of (path, tail, conv_id)."""
    trie = shard_trie([[step["node"] for step in row["path"]] for row in rows], [row["tail"] for row in rows])
    n = len(trie.place)
    brackets = Parentheses(trie.opens, block)
    closes = brackets.findclose(trie.place)
    first, beyond = trie.owner[trie.place], trie.owner[closes]
    steps = [rows[i]["path"][d] for i, d in zip(first.tolist(), trie.depth.tolist())]
    n_convs, lowest, points = (
        np.array([step[name] for step in steps], np.int64) for name in ("n_convs", "first_conv", "points")
    )
    here = (n_convs - 1) * points
    gain = np.zeros(len(trie.opens) + 1, np.int64)
    gain[trie.place + 1] = here
    gain = np.cumsum(gain)
    rooted = trie.parent < 0
    tails = np.array([row["tail"] for row in rows], bool)
    children = np.bincount(trie.parent[~rooted], minlength=n) + np.bincount(trie.last[tails], minlength=n)
    names = np.array([row["conv_id"] for row in rows], np.int64)
    stops = np.flatnonzero(~tails)
    counts = np.bincount(trie.last[stops], minlength=n)
    begin = np.cumsum(counts) - counts
    ending = names[stops][np.argsort(trie.last[stops], kind="stable")]
    spine = (first == 0) | (beyond == len(rows))
    digests, lists = [], []
    for i in range(n):
        own = ending[begin[i] : begin[i] + counts[i]]
        digests.append(None if spine[i] else _digest(own) if len(own) else NOBODY)
        lists.append(_member_pieces(own) if spine[i] else [None])
    which = np.repeat(np.arange(n), [len(pieces) for pieces in lists])
    piece = np.concatenate([np.arange(len(pieces)) for pieces in lists])
    nodes = [step["node"] for step in steps]
    above = np.maximum(trie.parent, 0)
    for low in range(0, len(which), 4096):
        i, p = which[low : low + 4096], piece[low : low + 4096]
        top = rooted[i]
        columns = [
            np.full(len(i), shard),
            spine[i],
            pa.array([nodes[k] for k in i], pa.binary()),
            pa.array([None if t else nodes[k] for k, t in zip(above[i], top)], pa.binary()),
            trie.depth[i],
            lowest[i],
            pa.array(lowest[above[i]], mask=top),
            n_convs[i],
            here[i],
            (beyond - first)[i],
            children[i],
            (brackets.leaves[closes] - brackets.leaves[trie.place])[i],
            (gain[closes] - gain[trie.place])[i],
            ~trie.opens[trie.place + 1][i],
            pa.array([digests[k] for k in i], pa.string()),
            pa.array([lists[k][q] for k, q in zip(i, p)], pa.string()),
            p,
        ]
        yield pa.RecordBatch.from_arrays([pa.array(column) for column in columns], PART_NAMES)


def member_digests(lists: DataFrame) -> DataFrame:
    """(node, ends_sha256) from pieces (node, shard, piece, ends): each list is hashed piece after
    piece as it streams by."""
    dealt = lists.repartition("node").sortWithinPartitions("node", "shard", "piece")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([node], pa.binary()), pa.array([state.hexdigest()])], ["node", "ends_sha256"]
            )

        for batch in batches:
            for name, ends in zip(batch.column("node"), batch.column("ends")):
                if name.as_py() != node:
                    if state is not None:
                        yield done()
                    node, state = name.as_py(), hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ends.as_py().encode())
        if state is not None:
            yield done()

    return dealt.select("node", "ends").mapInArrow(digest, "node binary, ends_sha256 string")


def merged_spines(parts: DataFrame) -> DataFrame:
    """The nodes of spines from their parts in one or more shards."""
    some = settled(parts.where("piece = 0").drop("ends", "piece", "ends_sha256"))
    summed = some.groupBy("node").agg(
        *[F.first(c).alias(c) for c in ("parent", "depth", "conv_id", "parent_conv_id", "n_convs", "saved_here")],
        *[F.sum(c).alias(c) for c in ("members", "children", "leaves", "saved")],
        F.sum(F.col("leaf").cast("long")).alias("leaf_parts"),
        F.count("*").alias("shards"),
        F.min("shard").alias("first"),
        F.max("shard").alias("last"),
    )
    summed = settled(summed)
    # a child in several shards has been counted in each
    again = summed.where("shards > 1 and parent is not null").groupBy("parent")
    again = again.agg(F.sum(F.col("shards") - 1).alias("again")).withColumnRenamed("parent", "node")
    fixed = summed.join(again, "node", "left")
    fixed = settled(fixed.withColumn("children", F.col("children") - F.coalesce("again", F.lit(0))))
    leaf = F.when(F.col("children") == 0, 1).otherwise(0)
    own = fixed.where("shards > 1").select(
        F.col("first").alias("shard"),
        "depth",
        "node",
        (leaf - F.col("leaf_parts")).cast("long").alias("leaf_change"),
        ((1 - F.col("shards")) * F.col("saved_here")).alias("saved_change"),
    )
    # nodes that begin in a shard and go on behind it lie on one path, so (shard, depth) is their
    # depth-first order; a row before each shard says what has been changed before it
    starts = some.select("shard").distinct().select(
        "shard",
        F.lit(-1).cast("long").alias("depth"),
        F.lit(None).cast("binary").alias("node"),
        F.lit(0).cast("long").alias("leaf_change"),
        F.lit(0).cast("long").alias("saved_change"),
    )
    folds = {
        "leaves_before": Fold("sum", F.col("leaf_change"), inclusive=False),
        "saved_before": Fold("sum", F.col("saved_change"), inclusive=False),
    }
    line = settled(own.unionByName(starts))
    sums = settled(
        running(line, [], ["shard", "depth"], folds, chunks=chunk_levels(F.col("shard"), SHARD_BITS, 3))
        .select("shard", "node", *[F.coalesce(c, F.lit(0)).alias(c) for c in folds])
    )
    begin = sums.where("node is not null").drop("shard")
    end = sums.where("node is null").select(
        F.col("shard").alias("last"),
        F.col("leaves_before").alias("leaves_after"),
        F.col("saved_before").alias("saved_after"),
    )
    changed = fixed.where("shards > 1").join(begin, "node").join(end, "last")
    changed = changed.withColumns(
        {
            "leaves": F.expr("leaves + leaves_after - leaves_before"),
            "saved": F.expr("saved + saved_after - saved_before"),
        }
    ).select(fixed.columns)
    nodes = changed.unionByName(fixed.where("shards = 1"))
    lists = parts.where("ends is not null").select("node", "shard", "piece", "ends")
    digests = member_digests(lists)
    return nodes.join(digests, "node", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NOBODY)))


def prefix_trie(
    rows: DataFrame, family: int = FAMILY, shared: int = SHARED, block: int = BLOCK, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256."""
    steps, totals = rebuilt(settled(turns(rows)), family, shared)
    totals = settled(totals)
    steps = settled(prefixes(settled(steps), hot_rows))
    nodes = settled(
        steps.groupBy("node").agg(
            F.count("*").alias("n_convs"), F.min("conv_id").alias("first_conv"), F.min("depth").alias("depth")
        )
    )
    common = nodes.where("n_convs > 1").drop("depth")
    on_paths = join_groups(steps.drop("turn_key"), common, "node", "n_convs")
    step = F.struct("depth", "node", "n_convs", "first_conv", "points")
    paths = on_paths.groupBy("conv_id").agg(F.sort_array(F.collect_list(step)).alias("path"))
    all_ = totals.agg(F.count("*").alias("n"), F.min("conv_id").alias("least")).first()
    root = F.struct(
        F.lit(0).cast("long").alias("depth"),
        F.lit(b"").alias("node"),
        F.lit(all_["n"]).cast("long").alias("n_convs"),
        F.lit(all_["least"]).cast("long").alias("first_conv"),
        F.lit(0).cast("long").alias("points"),
    )
    path = F.when(F.col("path").isNull(), F.array(root)).otherwise(F.concat(F.array(root), "path"))
    lines = settled(
        totals.join(paths, "conv_id", "left")
        .withColumn("path", path)
        .withColumn("tail", F.size("path") - 1 < F.col("total"))
    )
    order = ["path", "tail", "conv_id"]
    dealt = lines.drop("total").repartitionByRange(*order).sortWithinPartitions(*order)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held = [row for batch in batches for row in batch.to_pylist()]
        if held:
            yield from shard_nodes(TaskContext.get().partitionId(), held, block)

    parts = landed(dealt.mapInArrow(describe, PARTS), "trie")
    columns = [
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        "ends_sha256",
    ]
    inside = parts.where("not spine").select(*columns)
    spines = merged_spines(parts.where("spine")).select(*columns)
    ends = settled(
        lines.where("tail").select(
            "conv_id",
            "total",
            (F.size("path") - 1).cast("long").alias("joined"),
            F.element_at("path", -1)["first_conv"].alias("join_conv"),
        )
    )
    single = nodes.where("n_convs = 1").select(F.col("first_conv").alias("conv_id"), "depth", "n_convs")
    alone = join_groups(settled(single), ends, "conv_id", "total")
    last = F.col("depth") == F.col("total")
    mine = F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)
    chains = alone.select(
        "conv_id",
        "depth",
        F.when(F.col("depth") == F.col("joined") + 1, F.col("join_conv"))
        .otherwise(F.col("conv_id"))
        .alias("parent_conv_id"),
        "n_convs",
        F.when(last, 0).otherwise(1).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"),
        F.lit(0).cast("long").alias("saved_tokens"),
        F.when(last, mine).otherwise(F.lit(NOBODY)).alias("ends_sha256"),
    )
    return inside.unionByName(spines).unionByName(chains)
