"""Running folds over the ordered rows of a key, for keys of any size.

A plain window function sends all rows of a key to one task. Here that happens only to keys of
at most ``hot_rows`` rows. The rows of a larger key are cut, along their order, into chunks:
a chunk holds a fixed span of the order column, so it has a bounded number of rows however
the data are spread. Each chunk is folded by itself; the chunks' totals are then folded the
same way, one level up, and give each chunk the fold of everything before it:

    result(row) = fold(earlier chunks of the key)  +  fold(earlier rows of the chunk)

Chunks are folded over two levels, so that a bounded number meets in one task also where the
order column is so sparse that each row is a chunk of its own. The first order column must not
repeat without bound within a large key; where it may, pass the table through
:func:`range_chunks`, which cuts at ranges of all order columns. Chunks are a function of the row
(or of checkpointed rows), so a lost task recomputes the same ones.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.operators.skew import HOT, HOT_ROWS, mark_hot
from tideline.session import settled

CHUNK = "_chunk"
#: The key columns in one, in which a null equals a null.
KEYS = "_keys"
CHUNK_BITS = 20
LEVELS = 2
TIME_CHUNK_BITS = 24


@dataclass(frozen=True)
class Fold:
    """What to fold: ``op`` is sum, max, min or text (joined with ``sep``)."""

    op: str
    value: Column
    inclusive: bool = True
    sep: str = ""

    def over(self, value: Column, rows) -> Column:
        if self.op == "text":
            text = F.array_join(F.collect_list(value).over(rows), self.sep)
            return F.when(F.count(value).over(rows) > 0, text)
        return getattr(F, self.op)(value).over(rows)

    def total(self, value: Column, order: Sequence[str]) -> Column:
        if self.op == "text":
            pairs = F.sort_array(F.collect_list(F.struct(*order, value.alias("_text"))))
            text = F.array_join(F.transform(pairs, lambda p: p["_text"]), self.sep)
            return F.when(F.count(value) > 0, text)
        return getattr(F, self.op)(value)

    def combine(self, before: Column, here: Column) -> Column:
        if self.op == "sum":
            return F.coalesce(before + here, before, here)
        if self.op == "text":
            return F.coalesce(F.concat(before, F.lit(self.sep), here), before, here)
        return (F.greatest if self.op == "max" else F.least)(before, here)


def chunk_levels(order: Column, bits: int | None = None, levels: int = LEVELS) -> list[Column]:
    """Chunk numbers of an integer order column, fine to coarse.

    With 20 bits a chunk holds at most 1,048,576 order values, and as many chunks meet in one of
    the second level; of those a 64-bit column has 16 million at most.
    """
    bits = CHUNK_BITS if bits is None else bits
    return [F.shiftright(order, bits * level) for level in range(1, levels + 1)]


def time_chunks(at: Column) -> list[Column]:
    """Chunks of a column of microseconds: 16.8 seconds each, then nine years."""
    return chunk_levels(at, TIME_CHUNK_BITS, 2)


def range_chunks(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], parts: int | None = None
) -> DataFrame:
    """Add the chunk columns that :func:`running` works on by dealing the rows by ranges of
    (keys, order): a chunk is what one key has in one partition, however its order repeats.

    The dealt rows are checkpointed, as ranges are found by sampling. Without ``parts`` Spark
    sizes the partitions by their bytes.
    """
    columns = [F.col(name).asc_nulls_first() for name in (*keys, *order)]
    mine = df.withColumn("_tie", F.monotonically_increasing_id())
    count = [] if parts is None else [parts]
    dealt = mine.repartitionByRange(*count, *columns, "_tie").drop("_tie")
    if keys:
        dealt = dealt.withColumns({KEYS: F.struct(*keys), HOT: F.xxhash64(*keys)})
    return settled(dealt.withColumn(f"{CHUNK}0", F.spark_partition_id().cast("long")))


def with_chunks(
    df: DataFrame, keys: Sequence[str], chunks: Sequence[Column], hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Add the chunk columns that :func:`running` works on; they are null for keys that are not
    hot. Folds that follow each other on the result share one shuffle. A column ``_hot`` from
    :func:`mark_hot` is used if present."""
    levels = list(chunks)
    if keys:
        df = df if HOT in df.columns else mark_hot(df, keys, hot_rows)
        df = df.withColumn(KEYS, F.struct(*keys))
        levels = [F.when(F.col(HOT).isNotNull(), level) for level in levels]
    return df.select("*", *[level.alias(f"{CHUNK}{i}") for i, level in enumerate(levels)])


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    folds: Mapping[str, Fold],
    *,
    chunks: Sequence[Column] | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add one column per fold: the fold of the key's rows up to each row.

    ``order`` names the columns that order the rows of a key; ``chunks`` are integer columns,
    fine to coarse, that grow with them (default: from the first order column). Without keys
    the whole table is one ordered sequence.
    """
    keys, order = list(keys), list(order)
    marked = df
    if f"{CHUNK}0" not in df.columns:
        levels = chunks if chunks is not None else chunk_levels(F.col(order[0]))
        marked = with_chunks(df, keys, levels, hot_rows)
    names = [name for name in marked.columns if name.startswith(CHUNK)]
    # With _hot and the chunk, rows are partitioned the same way for the fold and for the join
    # with what came before, and filters on either pass below earlier folds.
    group = [KEYS, HOT] if keys else []
    values = marked.select(
        "*", *[fold.value.alias(f"_value_{name}") for name, fold in folds.items()]
    )
    within = Window.partitionBy(*group, names[0]).orderBy(*order)
    local = values.select(
        *dict.fromkeys([*df.columns, *group, names[0]]),
        *[
            fold.over(
                F.col(f"_value_{name}"),
                within.rowsBetween(Window.unboundedPreceding, 0 if fold.inclusive else -1),
            ).alias(f"_here_{name}")
            for name, fold in folds.items()
        ],
    )
    totals = (
        values.filter(F.col(names[0]).isNotNull())
        .groupBy(*group, *names)
        .agg(
            *[
                fold.total(F.col(f"_value_{name}"), order).alias(f"_before_{name}")
                for name, fold in folds.items()
            ]
        )
    )
    before = _before_chunks(totals, group, names, folds)
    return local.join(before, [*group, names[0]], "left").select(
        *df.columns,
        *[
            fold.combine(F.col(f"_before_{name}"), F.col(f"_here_{name}")).alias(name)
            for name, fold in folds.items()
        ],
    )


def _before_chunks(
    totals: DataFrame, keys: list[str], names: list[str], folds: Mapping[str, Fold]
) -> DataFrame:
    """Per chunk, the fold of all earlier chunks of its key, through the coarser levels."""
    chunk, coarser = names[0], names[1:]
    columns = {name: f"_before_{name}" for name in folds}
    earlier = (
        Window.partitionBy(*keys, *coarser[:1])
        .orderBy(chunk)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    local = totals.select(
        *keys,
        chunk,
        *coarser[:1],
        *[
            folds[n].over(F.col(c), earlier).alias(f"_in{c}" if coarser else c)
            for n, c in columns.items()
        ],
    )
    if not coarser:
        return local
    upper = totals.groupBy(*keys, *coarser).agg(
        *[folds[n].total(F.col(c), [chunk]).alias(c) for n, c in columns.items()]
    )
    above = _before_chunks(upper, keys, coarser, folds)
    return local.join(above, keys + coarser[:1], "left").select(
        *keys,
        chunk,
        *[folds[n].combine(F.col(c), F.col(f"_in{c}")).alias(c) for n, c in columns.items()],
    )


def numbered(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "rn", **options
) -> DataFrame:
    """Number the rows of each key from 1, in order."""
    return running(df, keys, order, {name: Fold("sum", F.lit(1).cast("long"))}, **options)
