"""Groups of spelling variants: words that differ by exactly one edit.

Words are counted over all texts. Two words are near if one inserted, deleted or replaced code
point turns one into the other, that is, if their common prefix and common suffix together are as
long as the longer word less one. To find all such pairs, each word is cut into three pieces, and
of a near pair at least two pieces agree: words that share all but one piece meet in a bucket. In
a bucket, words lie as padded matrices of code points, aligned left and right, and blocks of them
are compared densely; only near pairs come out, each in one bucket. A bucket of more words than a
block is cut into blocks by a hash, and each pair of blocks is a task's unit of work, so no bucket
is ever held whole.

A word's form is its most frequent near word (ties: the smallest in code-point order) if that is
at least twice as frequent. Counts at least double from word to form, so forms end after 62 steps
at most and pointers are doubled a few times to reach the root.

Defined results: a null or empty text has no words; a null doc_id counts as the empty string in
the hash that plants misspellings; repeated rows are counted as often as they occur; a table
without frequent words gives an empty result. Columns beyond doc_id and text play no part and may
have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import settled, ship_by_value
from .common import if_small, join_groups

ship_by_value(__name__)

RUN = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: One in so many occurrences loses a code point.
PLANT = 97
#: Fewest code points and occurrences of a word.
LEAST_LENGTH = 5
LEAST_COUNT = 3
PIECES = 3
#: Words of a block.
BLOCK = 2048
#: Tiles of at most so many rows are compared row by row at growing distance, not as a matrix.
NARROW = 24


def word_counts(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    plant: int = PLANT,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
) -> DataFrame:
    """(word, n): the distinct words with their occurrences over all texts."""
    low = F.translate(F.col(text).cast("string"), UPPER, LOWER)
    runs = docs.select(
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(low, F.lit(RUN), F.lit(0))).alias("run"),
    )
    hashed = runs.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(
        F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run"))
    )
    words = hashed.select(F.when(F.col("h") % plant == 0, shorter).otherwise(F.col("run")).alias("word"))
    return (
        words.where(F.length("word") >= least_length)
        .groupBy("word")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= least_count)
    )


def bucketed(words: DataFrame, pieces: int = PIECES) -> DataFrame:
    """A row per word and bucket: bucket (a hash), size (code points of the bucket's shorter words),
    low (where the piece that is left out begins), word, n.

    A word of m code points is in the buckets of size m, and, as the longer one of its pairs, in
    those of size m - 1.
    """
    length = F.length("word")
    made = []
    for less in (0, 1):
        size = length - less
        for piece in range(pieces):
            low = (size * piece / pieces).cast("int")
            high = (size * (piece + 1) / pieces).cast("int")
            tail = size - high
            kept = [
                F.substring(F.col("word"), F.lit(1), low),
                F.substring(F.col("word"), length - tail + 1, tail),
            ]
            made.append(
                F.struct(
                    F.xxhash64(size, F.lit(piece), *kept).alias("bucket"),
                    size.alias("size"),
                    low.alias("low"),
                )
            )
    return words.select("word", "n", F.explode(F.array(*made)).alias("b")).select("b.*", "word", "n")


def matrices(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points aligned left, aligned right, and the lengths; padding is 0."""
    lengths = np.array([len(word) for word in words], np.int32)
    flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
    # the pad must differ from every code point: they are moved up by one
    most = int(flat.max(initial=0)) + 1
    kind = np.uint8 if most < 1 << 8 else np.uint16 if most < 1 << 16 else np.uint32
    width = int(lengths.max(initial=0))
    left = np.zeros((len(words), width), kind)
    right = np.zeros((len(words), width), kind)
    at = np.arange(width)
    points = (flat + 1).astype(kind)
    left[at < lengths[:, None]] = points
    right[at >= width - lengths[:, None]] = points
    return left, right, lengths


def shared_prefix(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Leading places in which rows agree, with broadcasting; a pad agrees with nothing."""
    alive = np.ones(np.broadcast_shapes(one.shape[:-1], other.shape[:-1]), bool)
    found = np.zeros(alive.shape, np.uint8 if one.shape[-1] < 256 else np.int32)
    for i in range(one.shape[-1]):
        a = one[..., i]
        alive &= (a == other[..., i]) & (a > 0)
        if not alive.any():
            break
        found += alive
    return found


def near_rows(
    left: np.ndarray,
    right: np.ndarray,
    lengths: np.ndarray,
    size: np.ndarray,
    low: np.ndarray,
    ones: np.ndarray,
    others: np.ndarray,
) -> np.ndarray:
    """Whether rows ``ones`` and ``others`` (index arrays that broadcast) are near and belong to
    this bucket. Of the buckets that a pair shares, that of the first piece counts: there the
    common suffix does not reach over the piece."""
    a, b = lengths[ones], lengths[others]
    longest = np.maximum(a, b)
    prefix = shared_prefix(left[ones], left[others])
    suffix = shared_prefix(right[ones][..., ::-1], right[others][..., ::-1]).astype(np.int32)
    shortest = np.minimum(a, b)
    of_bucket = size[ones]
    near = (prefix + suffix >= longest - 1) & (longest - shortest <= 1) & (shortest == of_bucket)
    # equal words come only from hash clashes between buckets
    near &= ~((prefix == longest) & (a == b))
    start = low[ones]
    return near & ((start == 0) | (suffix < of_bucket - start))


def tile_pairs(
    words: list[str], size: np.ndarray, low: np.ndarray, tile: np.ndarray, side: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Near pairs, as row numbers, inside tiles that lie row after row. A tile of two blocks
    (``side`` 0 and 1) pairs rows of different blocks only, one of a single block (``side`` -1)
    all its rows."""
    left, right, lengths = matrices(words)
    edges = np.flatnonzero(np.diff(tile, prepend=tile[:1] - 1)) if len(tile) else np.zeros(0, int)
    ends = np.append(edges[1:], len(tile))
    counts = ends - edges
    ones, others = [], []

    def note(a: np.ndarray, b: np.ndarray, good: np.ndarray) -> None:
        a, b = np.broadcast_arrays(a, b)
        ones.append(a[good])
        others.append(b[good])

    slim = np.repeat((counts <= NARROW), counts)
    for step in range(1, NARROW):
        a = np.flatnonzero(slim[:-step] & (tile[step:] == tile[:-step])) if step < len(tile) else []
        if not len(a):
            break
        a = a[(side[a] < 0) | (side[a] != side[a + step])]
        if len(a):
            note(a, a + step, near_rows(left, right, lengths, size, low, a, a + step))
    for begin, end in zip(edges[counts > NARROW], ends[counts > NARROW]):
        rows = np.arange(begin, end)
        if side[begin] < 0:
            for i in range(0, len(rows), 512):
                a, b = rows[i : i + 512, None], rows[None, i:]
                good = near_rows(left, right, lengths, size, low, a, b)
                note(a, b, good & (a < b))
        else:
            first, second = rows[side[rows] == 0], rows[side[rows] == 1]
            for i in range(0, len(first), 512):
                a, b = first[i : i + 512, None], second[None, :]
                note(a, b, near_rows(left, right, lengths, size, low, a, b))
    if not ones:
        return np.zeros(0, int), np.zeros(0, int)
    return np.concatenate(ones), np.concatenate(others)


def near_pairs(words: DataFrame, pieces: int = PIECES, block: int = BLOCK) -> DataFrame:
    """(word, near, near_n) for each near word of each word, once. Pass a settled table (word, n)."""
    rows = settled(bucketed(words, pieces))
    sizes = settled(rows.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1"))
    met = join_groups(rows, sizes, "bucket", "members", block)
    # a bucket of several blocks: two blocks meet in one tile, and a word goes to the tiles of its
    # block with every block
    met = met.withColumn("blocks", F.ceil(F.col("members") / block).cast("long"))
    met = met.withColumn("mine", F.pmod(F.xxhash64("word"), F.col("blocks")))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    side = F.when(F.col("mine") == F.col("other"), -1).when(F.col("mine") < F.col("other"), 0)
    tiles = met.select(
        F.xxhash64("bucket", F.least("mine", "other"), F.greatest("mine", "other")).alias("tile"),
        side.otherwise(1).alias("side"),
        "size",
        "low",
        "word",
        "n",
    )
    tiles = tiles.repartition("tile").sortWithinPartitions("tile")

    def flush(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(parts).combine_chunks()
        names = table.column("word").to_pylist()
        column = {c: table.column(c).to_numpy() for c in ("tile", "side", "size", "low", "n")}
        a, b = tile_pairs(names, column["size"], column["low"], column["tile"], column["side"])
        texts = table.column("word").combine_chunks()
        ones, others = np.concatenate([a, b]), np.concatenate([b, a])
        return pa.RecordBatch.from_arrays(
            [texts.take(pa.array(ones)), texts.take(pa.array(others)), pa.array(column["n"][others])],
            ["word", "near", "near_n"],
        )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            tile = batch.column("tile").to_numpy()
            cut = int(np.searchsorted(tile, tile[-1]))
            # the last tile may go on in the next batch
            if rows + cut >= 4 * BLOCK and cut:
                yield flush([*held, batch.slice(0, cut)])
                held, rows, batch = [], 0, batch.slice(cut)
            held.append(batch)
            rows += batch.num_rows
        if held:
            yield flush(held)

    return tiles.mapInArrow(compare, "word string, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for a table (word, form) in which forms never lead back: pointers are doubled
    until each points to a word without a form."""
    steps = forms.select("word", F.col("form").alias("root"))
    while True:
        at = if_small(steps.select(F.col("word").alias("root"), F.col("root").alias("next")))
        moved = settled(steps.join(at, "root", "left"))
        # words that have arrived stay in the table, as places that others point to
        steps = moved.select("word", F.coalesce("next", "root").alias("root"))
        if moved.where("next is not null").isEmpty():
            return steps


def variants(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    plant: int = PLANT,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    pieces: int = PIECES,
    block: int = BLOCK,
) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    words = settled(word_counts(docs, doc_id, text, plant, least_length, least_count))
    best = (
        near_pairs(words, pieces, block)
        .groupBy("word")
        .agg(
            F.count("*").alias("n_near"),
            F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("best"),
        )
    )
    far = F.coalesce(-F.col("best.less") < 2 * F.col("n"), F.lit(True))
    named = settled(
        words.join(best, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(~far, F.col("best.form")).alias("form"),
            F.when(~far, -F.col("best.less")).alias("form_n"),
        )
    )
    ends = roots(named.where("form is not null").select("word", "form"))
    return named.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
