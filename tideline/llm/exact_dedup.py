"""Exact deduplication with two passes over a Bloom filter (DataFrame functions only).

Pass one counts the bits that the documents' hashes set. Only bits set at least twice are kept:
a document all of whose bits are such bits may have a copy, any other has none. That filter is
an ordinary small table, at most ``filter_bits / 64`` rows of one 64-bit word, and is broadcast.
In pass two documents outside the filter pass straight through; only the others shuffle, grouped
by SHA-256.

The filter has a fixed greatest size, so a corpus of more than ``filter_bits / BITS_EACH`` documents is
judged in slices of its hash space, one after the other, each with a filter of its own: of documents
without a copy 0.6 % become suspects, at any size. The narrow table of hashes is sorted by slice
inside its tasks and written as Parquet, so that a slice reads its own pages of it.

Defined results: a null text counts as empty; texts that differ only in runs of blanks are equal;
a null doc_id sorts after all others; of rows repeated with the same text and doc_id exactly one
is kept; an empty table gives an empty result. Columns beyond doc_id and text play no part and
may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import work_folder
from .common import BLANKS, KEPT_ROWS, if_small, join_groups, landed, settled, whole

#: Bits of the filter: 2^27 bits are at most 2^21 words, 32 MB of data, on each executor.
FILTER_BITS = 1 << 27
#: Bits that one hash sets.
HASHES = 2
#: Bits of the filter for each document.
BITS_EACH = 24


def normal_sha256(text: Column) -> Column:
    """SHA-256 (hex) of a text with each run of blanks replaced by one space."""
    return F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " "), 256)


def _bits(sha: Column, filter_bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(sha, F.lit(i)), F.lit(filter_bits)) for i in range(HASHES)]


def repeated_bits(hashes: DataFrame, sha: str, filter_bits: int) -> DataFrame:
    """The filter: (word, mask) of the bits that at least two of the hashes set."""
    bit = F.col("bit")
    return (
        hashes.select(F.explode(F.array(*_bits(F.col(sha), filter_bits))).alias("bit"))
        .groupBy("bit")
        .count()
        .where("count > 1")
        .groupBy(F.shiftright(bit, 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("mask"))
    )


def with_suspicion(df: DataFrame, sha: str, bits: DataFrame, filter_bits: int) -> DataFrame:
    """Add ``_suspect``: whether the filter has all bits of the row's hash."""
    suspect = F.lit(True)
    for i, bit in enumerate(_bits(F.col(sha), filter_bits)):
        part = F.broadcast(bits.select(F.col("word").alias(f"_w{i}"), F.col("mask").alias(f"_m{i}")))
        df = df.withColumn(f"_bit{i}", bit)
        df = df.join(part, F.shiftright(F.col(f"_bit{i}"), 6) == F.col(f"_w{i}"), "left")
        suspect = suspect & F.expr(f"coalesce(getbit(_m{i}, cast(_bit{i} & 63 as int)), 0) = 1")
    inner = [f"{name}{i}" for i in range(HASHES) for name in ("_w", "_m", "_bit")]
    return df.withColumn("_suspect", suspect).drop(*inner)


def slices(docs: DataFrame, filter_bits: int) -> int:
    """Into how many slices the hashes of these documents are cut."""
    return max(1, -(-docs.count() * BITS_EACH // filter_bits))


def judged(prints: DataFrame, sha: str, number: int, filter_bits: int) -> DataFrame:
    """The rows with ``_suspect``, from two passes over each slice of their hashes."""
    if number == 1:
        known = settled(prints)
        return with_suspicion(known, sha, repeated_bits(known, sha, filter_bits), filter_bits)
    at = F.pmod(F.xxhash64(F.col(sha), F.lit(-1)), F.lit(number)).cast("int")
    sliced = landed(prints.withColumn("_slice", at).sortWithinPartitions("_slice"), "hashes")
    path = work_folder(prints.sparkSession, "judged")
    for i in range(number):
        part = sliced.where(F.col("_slice") == i).drop("_slice")
        marked = with_suspicion(part, sha, repeated_bits(part, sha, filter_bits), filter_bits)
        marked.write.parquet(f"{path}/slice={i}")
    schema = marked.schema
    return prints.sparkSession.read.schema(schema).parquet(path).select(*schema.names)


def exact_groups(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", filter_bits: int = FILTER_BITS
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    prints = docs.select(
        F.col(doc_id).alias("doc_id"), normal_sha256(F.col(text)).alias("text_sha256")
    ).withColumn("_row", F.monotonically_increasing_id())
    marked = judged(prints, "text_sha256", slices(docs, filter_bits), filter_bits)
    single = marked.where(~F.col("_suspect")).select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        "text_sha256",
    )
    suspects = settled(marked.where("_suspect").drop("_suspect"))
    groups = settled(
        suspects.groupBy("text_sha256").agg(
            F.count("*").alias("group_size"),
            F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_row")).alias("_first"),
        )
    )
    several = join_groups(suspects, groups, "text_sha256", "group_size").select(
        "doc_id",
        F.col("_first.doc_id").alias("keep_id"),
        "group_size",
        (F.col("_row") == F.col("_first._row")).alias("kept"),
        "text_sha256",
    )
    return single.unionByName(several)


def keep_first(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", filter_bits: int = FILTER_BITS
) -> DataFrame:
    """The documents that stay, with all their columns.

    Whole rows shuffle only for suspects, and of those one per task and text: the smallest row
    of a text is found by partial aggregation, so many copies do not meet in one task. Where the
    hashes are judged in slices, the suspects' hashes that do repeat are named to the documents:
    broadcast if they are counted to be few, else by a join on the hash.
    """
    rows = whole(docs).withColumn("_sha", normal_sha256(F.col(f"doc.`{text}`")))
    hashes = docs.select(normal_sha256(F.col(text)).alias("_sha"))
    number = slices(docs, filter_bits)
    if number == 1:
        hashes = settled(hashes)
        marked = with_suspicion(rows, "_sha", repeated_bits(hashes, "_sha", filter_bits), filter_bits)
        suspects, single = marked.where("_suspect"), marked.where(~F.col("_suspect"))
    else:
        found = judged(hashes, "_sha", number, filter_bits).where("_suspect")
        again = if_small(found.groupBy("_sha").count().where("count > 1").select("_sha"), KEPT_ROWS)
        suspects, single = rows.join(again, "_sha", "left_semi"), rows.join(again, "_sha", "left_anti")
    first = F.struct(F.col(f"doc.`{doc_id}`").isNull(), F.col(f"doc.`{doc_id}`"))
    reduced = suspects.groupBy("_sha").agg(F.min_by("doc", first).alias("doc"))
    return single.select("doc.*").unionByName(reduced.select("doc.*"))
