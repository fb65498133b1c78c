"""Words: tokens, final and running counts."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.udtf import UserDefinedTableFunction

from tideline.functions.text import words_of
from tideline.operators.running import Fold, chunk_levels, running
from tideline.operators.skew import HOT_ROWS
from tideline.session import ship_by_value

ship_by_value(__name__)


def tokenize(
    lines: DataFrame,
    line: str = "value",
    keep: Sequence[str] = (),
    lower: bool = True,
    drop_empty: bool = False,
) -> DataFrame:
    """One row (word, 1) per word of a line, with the columns in ``keep``."""
    tokens = lines.select(*keep, F.explode(words_of(F.col(line), lower)).alias("word"))
    tokens = tokens.withColumn("one", F.lit(1))
    return tokens.filter(F.col("word") != "") if drop_empty else tokens


def tokens_at(lines: DataFrame, line: str, line_id: str, lower: bool = True) -> DataFrame:
    """Words with their place: (line_id, pos, word), pos from 0."""
    return lines.select(line_id, F.posexplode(words_of(F.col(line), lower)).alias("pos", "word"))


def word_count(tokens: DataFrame, word: str = "word") -> DataFrame:
    """Rows per word. Works on a stream too (update or complete mode)."""
    return tokens.groupBy(word).agg(F.count(F.lit(1)).alias("n"))


def word_count_running(
    tokens: DataFrame, line_id: str, pos: str = "pos", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Per token, how often its word has occurred up to it, in (line_id, pos) order.

    A frequent word is cut into chunks of one line each, bounded by the size of a text.
    """
    at = F.col(line_id)
    count = Fold("sum", F.lit(1).cast("long"))
    return running(
        tokens,
        ["word"],
        [line_id, pos],
        {"n": count},
        chunks=[at, *chunk_levels(at)],
        hot_rows=hot_rows,
    )


def flat_map_with_setup(
    df: DataFrame,
    setup: Callable[[Mapping[str, str]], Callable[[pd.DataFrame], pd.DataFrame]],
    parameters: Mapping[str, str],
    schema: str,
    teardown: Callable[[], None] | None = None,
) -> DataFrame:
    """A table function with a life cycle: ``setup(parameters)`` runs once per task and returns
    the function for the task's batches; ``teardown`` runs when the task ends."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        function = setup(parameters)
        try:
            for batch in batches:
                yield function(batch)
        finally:
            if teardown is not None:
                teardown()

    return df.mapInPandas(run, schema)


def _words(lines: pd.Series) -> tuple[np.ndarray, pd.Series]:
    """For each word of the lines the number of its line, and the word, by the rules of
    :func:`words_of`; a null has none."""
    texts = pa.array(lines, pa.string(), from_pandas=True)
    kept = pc.utf8_rtrim(pc.utf8_lower(texts), " ")
    # blanks alone give no word, an empty line gives an empty one
    blank = pc.and_(pc.equal(kept, ""), pc.not_equal(texts, ""))
    words = pc.split_pattern(pc.if_else(blank, pa.scalar(None, pa.string()), kept), " ")
    return pc.list_parent_indices(words).to_numpy(), pc.list_flatten(words).to_pandas()


def parametrized_tokenize(
    lines: DataFrame, line_id: str, line: str, parameters: Mapping[str, str]
) -> DataFrame:
    """Tokens through a Python table function, each tagged with the job parameter ``tag``."""

    def setup(params: Mapping[str, str]) -> Callable[[pd.DataFrame], pd.DataFrame]:
        tag = params["tag"]

        def split(batch: pd.DataFrame) -> pd.DataFrame:
            places, words = _words(batch[line])
            ids = batch[line_id].iloc[places].reset_index(drop=True)
            return pd.DataFrame({line_id: ids, "word": words, "one": 1, "tag": tag})

        return split

    columns = lines.select(line_id, line)
    kind = lines.schema[line_id].dataType.simpleString()
    return flat_map_with_setup(
        columns, setup, parameters, f"{line_id} {kind}, word string, one int, tag string"
    )


def table_function(
    setup: Callable[[Mapping[str, str]], Callable[[pa.RecordBatch], pa.Table]],
    parameters: Mapping[str, str],
    returns: str,
    teardown: Callable[[], None] | None = None,
) -> UserDefinedTableFunction:
    """A table function on Arrow batches with a life cycle: ``setup`` gets the parameters once per
    partition, before the first row, and gives what turns a batch into any number of rows;
    ``teardown`` runs after the last one. Use it on ``df.asTable()``, or register it and call it in
    SQL with ``TABLE (...)``; the rows stay in their partitions, nothing is shuffled. A partition
    without rows sets nothing up."""

    class Run:
        def __init__(self):
            self.convert = setup(parameters)

        def eval(self, batch: pa.RecordBatch) -> Iterator[pa.Table]:
            yield self.convert(batch)

        def terminate(self) -> Iterator[pa.Table]:
            if teardown is not None:
                teardown()
            return iter(())

    return F.arrow_udtf(Run, returnType=returns)


def tokenizer(
    line_id: str, line: str, kind: str, parameters: Mapping[str, str]
) -> UserDefinedTableFunction:
    """Tokens of the lines of a table with columns ``line_id`` (of type ``kind``) and ``line``,
    as rows of them with the word, 1, and the job parameter ``tag``."""

    def setup(params: Mapping[str, str]) -> Callable[[pa.RecordBatch], pa.Table]:
        tag = params["tag"]

        def split(batch: pa.RecordBatch) -> pa.Table:
            places, found = _words(batch.column(line).to_pandas())
            ids = batch.column(line_id).take(pa.array(places))
            ones, tags = pa.repeat(pa.scalar(1, pa.int32()), len(ids)), pa.repeat(tag, len(ids))
            word = pa.array(found, pa.string(), from_pandas=True)
            return pa.table([ids, word, ones, tags], names=[line_id, "word", "one", "tag"])

        return split

    return table_function(setup, parameters, f"{line_id} {kind}, word string, one int, tag string")
