"""Helpers that several corpus operators share: tables, cut lineage, ranks within a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import settled, work_folder

#: Blanks that separate words: space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = r"[\x20\x09-\x0D]+"
#: A word is a longest run of anything else.
WORD = r"[^\x20\x09-\x0D]+"
#: Bits of a row's number inside its partition, as monotonically_increasing_id() lays them out.
ROW_BITS = 33
#: Most rows of a narrow table that is broadcast.
BROADCAST_ROWS = 500_000
#: Most decisions on documents, two numbers each, that are broadcast to the documents; of more,
#: both are shuffled once.
KEPT_ROWS = 1_000_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def landed(df: DataFrame, purpose: str) -> DataFrame:
    """The same rows as a Parquet table in the shared folder, for wide rows that are read in
    part: later scans read only the columns that they need."""
    spark = df.sparkSession
    path = work_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """The same narrow rows, to be broadcast if they are counted to be at most ``rows``; beyond
    that Spark joins by shuffling and splits skewed keys."""
    known = settled(df)
    return F.broadcast(known) if known.count() <= rows else known


def compact(df: DataFrame, rows: int, per_part: int = 100_000) -> DataFrame:
    """Fewer partitions for a table of at most ``rows`` narrow rows, so that jobs over small
    tables do not write a file per default partition."""
    return df.coalesce(max(1, -(-rows // per_part)))


def counted(df: DataFrame) -> DataFrame:
    """Settled rows in few partitions, for a narrow table that several jobs read."""
    rows = settled(df)
    return compact(rows, rows.count())


def ranked(df: DataFrame, keys: Sequence[str], order: Sequence[str], rank: str) -> DataFrame:
    """Number the rows of each key from 0 in the given order, however many rows a key has.

    Rows are dealt by range of (key, order), so a key with a third of all rows spans a third of
    the partitions. A row's rank is its place within its partition plus the rows of its key in
    earlier partitions. That table has a row for each partition and key that meet, no more than
    partitions + keys, and is broadcast. Rows that agree in key and order are told apart by the
    partition that they came from, so repeated rows do not gather either.

    ``df`` is read twice (ranges are sampled first): pass something settled and narrow.
    """
    names = [*keys, *order]
    mine = df.withColumn("_tie", F.monotonically_increasing_id())
    placed = settled(
        mine.repartitionByRange(*[F.col(name).asc_nulls_last() for name in names], "_tie")
        .sortWithinPartitions(*[F.col(name).asc_nulls_last() for name in names], "_tie")
        .drop("_tie")
        .withColumn("_row", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_row", ROW_BITS))
    )
    met = placed.groupBy("_part", *keys).agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = met.select(
        F.struct("_part", *keys).alias("_met"),
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
    )
    here = F.struct("_part", *keys)
    joined = placed.join(if_small(starts), here.eqNullSafe(F.col("_met")))
    return joined.withColumn(rank, F.col("_row") + F.col("_shift")).drop(
        "_row", "_part", "_met", "_shift"
    )


def hash_bits(column: Column, digits: int) -> Column:
    """The first hex digits of a string's MD5 as a number: the same in Spark and other SQL."""
    return F.conv(F.substring(F.md5(column), 1, digits), 16, 10).cast("long")


def join_groups(
    rows: DataFrame, groups: DataFrame, key: str, size: str, hot: int = 1000
) -> DataFrame:
    """Join rows with a table of one row per key that counts the key's rows in ``size``.

    Few groups are broadcast, after counting. Of many groups, the rows of keys with more than
    ``hot`` rows stay where they are and meet a broadcast of those keys, which are fewer than
    rows / hot and are counted too; all others are shuffled. Pass settled tables: both are read
    more than once.
    """
    if groups.count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(groups), key)
    big = groups.where(F.col(size) > hot)
    known = settled(big)
    if known.count() > BROADCAST_ROWS:
        return rows.join(groups, key)
    many = rows.join(F.broadcast(known), key)
    rest = rows.join(F.broadcast(known.select(key)), key, "left_anti")
    return many.unionByName(rest.join(groups.where(F.col(size) <= hot), key))


def whole(docs: DataFrame) -> DataFrame:
    """The rows with all their columns in one struct ``doc``, so that no name clashes."""
    return docs.select(F.struct(*[docs[f"`{name}`"] for name in docs.columns]).alias("doc"))


def one_of_each(docs: DataFrame, same: Column) -> DataFrame:
    """(_one, doc): of the rows that agree in ``same`` (a struct of ``doc``'s columns) one, with all its
    columns. Only rows that are repeated shuffle; they are found by counting narrow rows."""
    rows = whole(docs).select(same.alias("_one"), "doc")
    repeated = settled(rows.groupBy("_one").count().where("count > 1").select(F.col("_one").alias("_again")))
    if repeated.isEmpty():
        return rows
    again = F.col("_one").eqNullSafe(F.col("_again"))
    known = if_small(repeated)
    # of rows that differ in other columns the first in the order of all columns
    order = F.to_json("doc")
    reduced = rows.join(known, again, "left_semi").groupBy("_one").agg(F.min_by("doc", order).alias("doc"))
    return rows.join(known, again, "left_anti").unionByName(reduced)


def keep(docs: DataFrame, decided: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The documents of which a row with their (doc_id, print) is ``kept`` in ``decided``, a row per
    document; of repeated rows one. What goes is named to the documents, as it is the lesser part."""
    one = F.struct(
        F.col(f"doc.`{doc_id}`").alias("doc_id"), text_print(F.col(f"doc.`{text}`")).alias("print")
    )
    named = decided.groupBy(F.struct("doc_id", "print").alias("_gone")).agg(F.max("kept").alias("kept"))
    gone = if_small(named.where("not kept").select("_gone"), KEPT_ROWS)
    single = one_of_each(docs, one)
    return single.join(gone, F.col("_one").eqNullSafe(F.col("_gone")), "left_anti").select("doc.*")


def text_print(text: Column) -> Column:
    """A short hash of a text, to tell apart rows that share a doc_id."""
    return F.xxhash64(text, F.lit(1))
