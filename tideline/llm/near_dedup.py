"""Near-duplicate documents by BagMinHash over word shingles.

Each document is the multiset of its five-word shingles (lower case, words separated by blanks).
Equal multisets are one node from the start, so copies cost one row each. A node's BagMinHash
signature is cut into bands; nodes that agree in a band meet in a bucket, and candidates are
verified by the weighted Jaccard similarity of their multisets, 0.8 or more.

Only buckets of several nodes matter: buckets are counted first, and no other row of a band goes
on. No bucket emits all its pairs. First each bucket's members are compared with its leader, the
first in one order of all nodes, so that buckets of the same nodes give the same pairs, and the
links that hold are closed to components. After that only pairs of different components can add
anything. Small buckets list these pairs; large ones are cut into blocks, and blocks of the members
outside the largest component are compared with all blocks as matrices, inside the tasks. So every
candidate pair is either decided or already connected. Before multisets travel for a listed pair, a
byte of each of its signature values is compared.

With 25 bands of 5 values a pair of similarity 0.8 is missed with probability 0.00005. A listed
pair is dropped unread if fewer than 78 of the 125 bytes agree, which has probability 0.000001 at
a similarity of 0.8 or more.

Defined results: a null or blank text is like no other document; a text with fewer than five words
is one shingle; of a class the smallest doc_id is kept, null last, and of rows repeated with it
exactly one; an empty table gives an empty result. Columns beyond doc_id and text play no part and
may have any name. Shingles are compared by 32-bit hashes within a pair.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_by_value
from .bagminhash import signatures
from .common import counted, if_small, join_groups, keep, landed, ranked, settled, text_print
from .components import components
from .shingles import WORDS, bags, chunks, mixed

ship_by_value(__name__)

SIMILARITY = 0.8
BANDS = 25
BAND_ROWS = 5
#: Buckets with more nodes than this compare blocks instead of listing pairs.
LARGE = 64
#: Nodes of a block.
BLOCK = 128
#: Columns of a block's matrix that are held at once.
SLAB = 1 << 14
#: Documents whose texts a worker decodes at once.
STEP = 512
#: Least share of signature values of a pair whose multisets are worth comparing.
ALIKE = 78 / 125
#: Most names of nodes that are broadcast to pick their multisets, 8 bytes each.
NAMES = 2_000_000


def band_hashes(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit hash per document and band, the band's number included."""
    values = signature.view(np.uint64).reshape(len(signature), bands, rows)
    found = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), values.shape[:2]).copy()
    for i in range(rows):
        found = mixed(found * np.uint64(0x9E3779B97F4A7C15) + values[:, :, i])
    return found.view(np.int64)


def fingerprints(
    docs: DataFrame, doc_id: str, text: str, words: int, bands: int, rows: int
) -> DataFrame:
    """Land one row per document: doc_id, print, row (its number), digest (of the multiset), size,
    bands, marks (a byte of each signature value), and items: the multiset as sorted 32-bit hashes
    of (shingle, copy)."""
    narrow = docs.select(
        F.col(doc_id).alias("doc_id"),
        text_print(F.col(text)).alias("print"),
        F.col(text).cast("string").alias("text"),
    )
    fields = [
        narrow.schema["doc_id"],
        T.StructField("print", T.LongType()),
        T.StructField("digest", T.BinaryType()),
        T.StructField("size", T.LongType()),
        T.StructField("bands", T.ArrayType(T.LongType())),
        T.StructField("marks", T.BinaryType()),
        T.StructField("items", T.BinaryType()),
    ]

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # small steps, so that a batch of long texts is not held twice
        steps = (batch.slice(low, STEP) for batch in batches for low in range(0, batch.num_rows, STEP))
        for batch in steps:
            texts = batch.column("text").to_pylist()
            for first, raws in chunks(texts):
                n = len(raws)
                found = bags(raws, words)
                signature = signatures(found, n, bands * rows)
                hashes = band_hashes(signature, bands, rows)
                marks = (mixed(signature.view(np.uint64)) >> np.uint64(56)).astype(np.uint8)
                copy = np.arange(found.weights.sum()) - np.repeat(
                    np.cumsum(found.weights) - found.weights, found.weights
                )
                keys = np.repeat(found.keys, found.weights)
                items = (mixed(keys + copy.astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
                         >> np.uint64(32)).astype("<u4")
                ends = np.concatenate([[0], np.cumsum(found.weights)])[found.bounds]
                digests, sizes, bags_, lists = [], [], [], []
                for i in range(n):
                    low, high = found.bounds[i], found.bounds[i + 1]
                    own = np.sort(items[ends[i] : ends[i + 1]])
                    sizes.append(len(own))
                    bags_.append(own.tobytes())
                    if not len(own):
                        digests.append(None)
                        lists.append(None)
                        continue
                    name = hashlib.blake2b(found.keys[low:high].tobytes(), digest_size=16)
                    name.update(found.weights[low:high].tobytes())
                    digests.append(name.digest())
                    lists.append(hashes[i])
                some = batch.slice(first, n)
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column("doc_id"),
                        some.column("print"),
                        pa.array(digests, pa.binary()),
                        pa.array(sizes, pa.int64()),
                        pa.array(lists, pa.list_(pa.int64())),
                        pa.array([mark.tobytes() for mark in marks], pa.binary()),
                        pa.array(bags_, pa.binary()),
                    ],
                    names=[field.name for field in fields],
                )

    described = narrow.mapInArrow(describe, T.StructType(fields))
    return landed(described.withColumn("row", F.monotonically_increasing_id()), "shingles")


def _values(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The values of a binary column one after the other, and how many each row has."""
    width = np.dtype(kind).itemsize
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(column.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    return raw.copy().view(kind), np.diff(ends) // width


def overlaps(batch: pa.RecordBatch) -> np.ndarray:
    """The weighted Jaccard similarity of the multisets in of_a and of_b, row by row."""
    rows = np.arange(len(batch), dtype=np.uint64)
    keys, total = [], np.zeros(len(batch), np.int64)
    for name in ("of_a", "of_b"):
        values, sizes = _values(batch.column(name), "<u4")
        keys.append(np.repeat(rows << np.uint64(32), sizes) | values)
        total += sizes
    both = np.concatenate(keys)
    both.sort()
    twice = both[1:][both[1:] == both[:-1]] >> np.uint64(32)
    shared = np.bincount(twice.astype(np.int64), minlength=len(batch))
    return shared / np.maximum(total - shared, 1)


def verified(pairs: DataFrame, items: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose multisets are similar enough; items has (node, items). Each pair
    brings the multiset of a to that of b: let b be the one that is in many pairs."""
    ones = items.join(if_small(pairs.withColumnRenamed("a", "node"), NAMES), "node")
    ones = ones.select(F.col("node").alias("a"), "b", F.col("items").alias("of_a"))
    others = items.join(if_small(pairs.select(F.col("b").alias("node")).distinct(), NAMES), "node", "left_semi")
    others = others.select(F.col("node").alias("b"), F.col("items").alias("of_b"))
    joined = ones.join(others, "b").select("a", "b", "of_a", "of_b")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, len(batch), 256):
                some = batch.slice(low, 256)
                yield some.select(["a", "b"]).filter(pa.array(overlaps(some) >= similarity))

    return joined.mapInArrow(check, "a long, b long")


def alike(pairs: DataFrame, marks: DataFrame, share: float = ALIKE) -> DataFrame:
    """The pairs (a, b) of which at least ``share`` of the marks agree; marks has (node, marks)."""
    left = marks.select(F.col("node").alias("a"), F.col("marks").alias("of_a"))
    right = marks.select(F.col("node").alias("b"), F.col("marks").alias("of_b"))
    ones = left.join(if_small(pairs, NAMES), "a")
    names = if_small(pairs.select("b").distinct(), NAMES)
    joined = ones.join(right.join(names, "b", "left_semi"), "b").select("a", "b", "of_a", "of_b")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                one, other = (
                    _values(batch.column(c), "u1")[0].reshape(len(batch), -1) for c in ("of_a", "of_b")
                )
                good = (one == other).sum(axis=1) >= share * one.shape[1]
                yield batch.select(["a", "b"]).filter(pa.array(good))

    return joined.mapInArrow(check, "a long, b long")


def _similar_blocks(left: list[dict], right: list[dict], similarity: float) -> list[tuple[int, int]]:
    """Links between members of different components, one per member and component."""
    members = [*left, *right]
    bags_ = [np.frombuffer(member["items"], "<u4") for member in members]
    sizes = np.array([len(bag) for bag in bags_])
    # equal hashes inside a bag would be one column
    _, columns = np.unique(np.concatenate(bags_), return_inverse=True)
    rows = np.repeat(np.arange(len(members)), sizes)
    order = np.argsort(columns, kind="stable")
    columns, rows = columns[order], rows[order]
    n = len(left)
    shared = np.zeros((n, len(right)), np.float32)
    for low in range(0, int(columns[-1]) + 1 if len(columns) else 0, SLAB):
        at, end = np.searchsorted(columns, [low, low + SLAB])
        slab = np.zeros((len(members), SLAB), np.float32)
        slab[rows[at:end], columns[at:end] - low] = 1
        shared += slab[:n] @ slab[n:].T
    similar = shared >= similarity * (sizes[:n, None] + sizes[None, n:] - shared)
    roots = np.array([member["root"] for member in members])
    similar &= roots[:n, None] != roots[None, n:]
    links = []
    for i in np.flatnonzero(similar.any(axis=1)):
        hits = np.flatnonzero(similar[i])
        for j in np.unique(roots[n:][hits], return_index=True)[1]:
            links.append((left[i]["node"], right[hits[j]]["node"]))
    return links


def _across_blocks(crowd: DataFrame, items: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) between components inside large buckets; crowd has (bucket, node, root, main),
    main being the root that is most frequent in the bucket (or just one of them)."""
    numbered = ranked(
        settled(crowd.withColumn("side", F.col("root") == F.col("main"))),
        ["bucket"],
        ["side", "root", "node"],
        "place",
    )
    members = numbered.join(items, "node").withColumn("block", F.expr(f"place div {BLOCK}"))
    blocks = landed(
        members.groupBy("bucket", "block").agg(
            F.collect_list(F.struct("node", "root", "items")).alias("members"),
            F.min("side").alias("inside"),
        ),
        "blocks",
    )
    names = blocks.select("bucket", "block", "inside")
    # a block with members outside the main component meets every block of its bucket from itself on
    one = names.where("not inside").select("bucket", F.col("block").alias("one"))
    other = names.select("bucket", F.col("block").alias("other"))
    pairs = one.join(other, "bucket").where("one <= other")
    first = blocks.select("bucket", F.col("block").alias("one"), F.col("members").alias("left"))
    second = blocks.select("bucket", F.col("block").alias("other"), F.col("members").alias("right"))
    met = pairs.join(first, ["bucket", "one"]).join(second, ["bucket", "other"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links = []
            for left, right in zip(batch.column("left"), batch.column("right")):
                links += _similar_blocks(left.as_py(), right.as_py(), similarity)
            yield pa.RecordBatch.from_arrays(
                [pa.array([link[i] for link in links], pa.int64()) for i in (0, 1)], ["a", "b"]
            )

    return met.select("left", "right").mapInArrow(compare, "a long, b long")


def similar_links(nodes: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Links (a, b) that connect all candidates similar enough: nodes is a landed table with node,
    size, bands, marks and items, of which each step reads what it needs."""
    buckets = nodes.select("node", "size", F.explode("bands").alias("bucket"))
    # the first exchange carries nothing but buckets; rows of those that are shared follow
    shared = counted(buckets.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1"))
    crowd = counted(join_groups(buckets, shared, "bucket", "n"))
    known = nodes.join(if_small(crowd.select("node").distinct(), NAMES), "node", "left_semi")
    known = landed(known.select("node", "marks", "items"), "candidates")
    items, marks = known.select("node", "items"), known.select("node", "marks")
    near = F.least("size", "other") >= F.greatest("size", "other") * similarity

    lead = F.struct(F.xxhash64("node").alias("at"), F.col("node").alias("node"), F.col("size").alias("size"))
    heads = counted(crowd.groupBy("bucket", "n").agg(F.min(lead).alias("leader")))
    led = join_groups(crowd.drop("n"), heads, "bucket", "n").select(
        "node", "size", F.col("leader.node").alias("mate"), F.col("leader.size").alias("other")
    )
    led = led.where("node <> mate").where(near)
    first = counted(led.select(F.col("node").alias("a"), F.col("mate").alias("b")).distinct())
    stars = settled(verified(counted(alike(first, marks)), items, similarity))
    roots = components(stars, "a", "b")
    rooted = counted(
        crowd.drop("n").join(roots, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    # the larger part of a bucket: its most frequent root among few kept per task
    spread = counted(
        rooted.groupBy("bucket", "root").count()
        .groupBy("bucket")
        .agg(
            F.sum("count").alias("members"),
            F.count("*").alias("roots"),
            F.max(F.struct("count", "root")).alias("main"),
        )
        .where("roots > 1")
        .select("bucket", "members", F.col("main.root").alias("main"))
    )
    mixed_ = counted(join_groups(rooted, spread, "bucket", "members"))
    small = mixed_.where(F.col("members") <= LARGE)
    mates = small.select(
        "bucket",
        F.col("node").alias("mate"),
        F.col("size").alias("other"),
        F.col("root").alias("its_root"),
    )
    across = small.join(mates, "bucket").where("root < its_root").where(near)
    ends = [F.least("node", "mate").alias("a"), F.greatest("node", "mate").alias("b")]
    # a node has met its leaders, which are lesser in their order, already
    rest = across.select(*ends).distinct()
    met = first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = counted(rest.join(if_small(met, NAMES), ["a", "b"], "left_anti"))
    listed = verified(counted(alike(rest, marks)), items, similarity)
    large = mixed_.where(F.col("members") > LARGE).select("bucket", "node", "root", "main")
    blocks = _across_blocks(large, items, similarity)
    return stars.unionByName(settled(listed)).unionByName(settled(blocks))


def classes(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    similarity: float = SIMILARITY,
    words: int = WORDS,
    bands: int = BANDS,
    band_rows: int = BAND_ROWS,
) -> DataFrame:
    """One row per document: doc_id, class_id (the smallest doc_id of its class), class_size,
    kept, and print (a hash of the text)."""
    prints = fingerprints(docs, doc_id, text, words, bands, band_rows)
    own = prints.select("doc_id", "print", "row", "digest")
    nodes = counted(
        own.where("digest is not null")
        .groupBy("digest")
        .agg(F.min("row").alias("node"), F.count("*").alias("copies"))
    )
    # of equal multisets the first row is the node; the others take no further part
    several = nodes.where("copies > 1")
    copies = join_groups(own.where("digest is not null"), several, "digest", "copies")
    copies = if_small(copies.where("row <> node").select("row"), NAMES)
    single = prints.where("digest is not null").join(copies, "row", "left_anti")
    links = similar_links(single.withColumnRenamed("row", "node"), similarity)
    roots = components(links, "a", "b")
    named = counted(
        nodes.select("digest", "node", "copies")
        .join(roots, "node", "left")
        .select("digest", "copies", F.coalesce("root", "node").alias("root"))
    )
    some = join_groups(own.where("digest is not null"), named, "digest", "copies")
    members = counted(
        some.select("doc_id", "print", "row", "root").unionByName(
            own.where("digest is null").select("doc_id", "print", "row", F.col("row").alias("root"))
        )
    )
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    groups = counted(
        members.groupBy("root").agg(F.count("*").alias("class_size"), F.min(order).alias("_first"))
    )
    return join_groups(members, groups, "root", "class_size").select(
        "doc_id",
        F.col("_first.doc_id").alias("class_id"),
        "class_size",
        (F.col("row") == F.col("_first.row")).alias("kept"),
        "print",
    )


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """One document of each class, with all its columns."""
    return keep(docs, classes(docs, doc_id, text, **how), doc_id, text)
