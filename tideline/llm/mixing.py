"""Mix sources to target weights by systematic sampling.

Every document of a source has the same expected number of copies, the source's target over its
size. These are summed along the source's documents in order, one random offset per source is
added, and a document is taken once for each whole number that its stretch of the sum crosses.
Documents are ordered by size, so each stretch of sizes gets its share and the words taken come
near the target. Order and offset come from hashes: reruns agree.

The sums are kept in units of 2^-24, so they are exact whatever the partitioning.

Defined results: a null text has size 0; a null source is a source of its own, after all others;
a source without words has target 0 and none of its documents is taken; repeated rows are
documents of their own; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import KEPT_ROWS, WORD, hash_bits, if_small, one_of_each, ranked, settled, text_print

#: Weights of the sources in code point order, repeating.
WEIGHTS = (3, 1, 2)
#: Share of all sizes that the mix should have.
SHARE = 1.5
#: No source and no document is taken more often.
MOST = 2
#: One copy in the units of the sums.
ONE = 1 << 24
SEED = "tideline"
#: Copies of a document that are made in one step.
RUN = 4096


def targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: int = MOST
) -> DataFrame:
    """Source, source_size, target: ``share`` of all sizes by weight, none above ``most`` times
    its size, what is above reshared by weight among the others.

    The reshared level is the one at which the targets min(most * size, level * weight) add up.
    Sources are walked in the order in which they reach their greatest target. The table has
    one row per source, and only it is walked in one task.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    # pmod gives 0, 1, 2, ... along the names
    place = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), place + 1)
    named = per_source.withColumn("weight", weight).withColumn("most", F.col("source_size") * most)
    full_at = (F.col("most") / F.col("weight")).alias("full_at")
    walk = Window.orderBy("full_at", F.col("source").asc_nulls_last())
    before = walk.rowsBetween(Window.unboundedPreceding, -1)
    after = walk.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (
        F.lit(share) * F.sum("source_size").over(everything)
        - F.coalesce(F.sum("most").over(before), F.lit(0))
    ) / F.sum("weight").over(after)
    walked = named.select("*", full_at).withColumn("level", level)
    open_level = F.when(F.col("level") <= F.col("full_at"), F.col("level"))
    # it falls from the first source that stays below its greatest target on
    return walked.withColumn("level", F.max(open_level).over(everything)).select(
        "source",
        "source_size",
        F.least(
            F.col("most").cast("double"),
            F.coalesce(F.col("level") * F.col("weight"), F.col("most").cast("double")),
        ).alias("target"),
    )


def _sampled(sizes: DataFrame, columns: Sequence[str], seed: str, **how) -> DataFrame:
    """The rows (source, size, key and ``columns``) with source_size, target and copies."""
    numbered = ranked(sizes, ["source"], ["size", "key"], "rank")
    goals = targets(sizes, **how).select(
        F.struct("source").alias("_source"), "source_size", "target"
    )
    each = F.round(F.expr(f"try_divide(target, source_size) * {ONE}")).cast("long")
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("_source.source"), F.lit("")))
    goals = goals.withColumn("_each", F.coalesce(each, F.lit(0))).withColumn(
        "_offset", F.pmod(hash_bits(name, 8), F.lit(ONE))
    )
    joined = numbered.join(if_small(goals), F.struct("source").eqNullSafe(F.col("_source")))
    crossed = "((rank + 1) * _each + _offset) div {0} - (rank * _each + _offset) div {0}"
    return joined.select(
        *columns, "size", "source", "source_size", "target", F.expr(crossed.format(ONE)).alias("copies")
    )


def _sizes(docs: DataFrame, doc_id: str, text: str, source: str) -> DataFrame:
    """Narrow rows: doc_id, source, size, key (of the order) and print (of the text)."""
    words = F.regexp_count(F.col(text), F.lit(WORD))
    return settled(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            F.col(source).alias("source"),
            F.coalesce(words, F.lit(0)).cast("long").alias("size"),
            F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))).alias("key"),
            text_print(F.col(text)).alias("print"),
        )
    )


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    seed: str = SEED,
    **how,
) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, source, copies."""
    sizes = _sizes(docs, doc_id, text, source)
    return _sampled(sizes, ["doc_id"], seed, **how).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
        "source",
        "copies",
    )


def mixed(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    seed: str = SEED,
    **how,
) -> DataFrame:
    """The mix itself: whole documents, each as often as it is taken.

    Copies are decided on narrow rows and joined back by doc_id, source and a hash of the text.
    Rows that agree in these are one document, with as many copies as they get together.
    """
    sizes = _sizes(docs, doc_id, text, source)
    same = ["doc_id", "source", "print"]
    taken = (
        _sampled(sizes, ["doc_id", "print"], seed, **how)
        .groupBy(F.struct(*same).alias("_same"))
        .agg(F.sum("copies").alias("_copies"))
        .where("_copies > 0")
    )
    one = F.struct(
        F.col(f"doc.`{doc_id}`").alias("doc_id"),
        F.col(f"doc.`{source}`").alias("source"),
        text_print(F.col(f"doc.`{text}`")).alias("print"),
    )
    single = one_of_each(docs, one)
    joined = single.join(if_small(taken, KEPT_ROWS), F.col("_one").eqNullSafe(F.col("_same")))
    # two steps, so that no array of a much repeated document gets long
    runs = joined.withColumn("_run", F.explode(F.expr(f"sequence(0L, (_copies - 1) div {RUN})")))
    rest = f"least({RUN}L, _copies - _run * {RUN}L)"
    return runs.withColumn("_n", F.explode(F.expr(f"sequence(1L, {rest})"))).select("doc.*")
