"""Token ids of documents, and the pieces that long documents are cut into.

A document's ids are those of the byte-level BPE tokenizer file, without special tokens, then one
closing id. Encoding runs on the rank form of the same vocabulary, which gives the same ids in a
fifth of the time; texts that hold the string of a special token go through the tokenizer file.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_by_value
from .kept import once

ship_by_value(__name__)

#: The tokenizer's files, by name in the installed package of public tokenizers.
VOCABULARY = "byte_bpe_50k"
#: Its only special token, as its file lists it.
SPECIAL = "<|endoftext|>"
#: The id that closes each document.
END_ID = 0
#: Most tokens of a piece and of a sequence.
CAPACITY = 2048


def encoder(vocabulary: str = VOCABULARY) -> Callable[[str], list[int]]:
    """The function from text to ids, loaded once per worker."""
    return once(f"encoder {vocabulary}", lambda: _loaded(vocabulary))


def _loaded(vocabulary: str) -> Callable[[str], list[int]]:
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    fast = tiktoken.Encoding(
        vocabulary,
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=ranks,
        special_tokens={},
    )
    exact = Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json"))

    def encode(text: str) -> list[int]:
        if SPECIAL in text:
            return exact.encode(text, add_special_tokens=False).ids
        return fast.encode_ordinary(text)

    return encode


def document_ids(text: str | None, vocabulary: str = VOCABULARY) -> np.ndarray:
    ids = encoder(vocabulary)(text) if text else []
    ids.append(END_ID)
    return np.array(ids, dtype="<u4")


def cut_points(length: int, capacity: int = CAPACITY) -> list[int]:
    """Starts of the pieces: all full but the first, which may be shorter."""
    return [0, *range(length % capacity or capacity, length, capacity)]


def pieces(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    vocabulary: str = VOCABULARY,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, and with_ids the ids
    (binary, little-endian unsigned 32-bit)."""
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    fields = [
        narrow.schema["doc_id"],
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ]
    if with_ids:
        fields.append(T.StructField("ids", T.BinaryType()))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # small steps, so that a batch of very long texts is not held twice
            for low in range(0, batch.num_rows, 256):
                some = batch.slice(low, 256)
                rows, numbers, starts, lengths, sums, out = [], [], [], [], [], []
                for row, value in enumerate(some.column("text")):
                    ids = document_ids(value.as_py(), vocabulary)
                    begins = cut_points(len(ids), capacity)
                    for number, (begin, end) in enumerate(zip(begins, [*begins[1:], len(ids)])):
                        raw = ids[begin:end].tobytes()
                        rows.append(row)
                        numbers.append(number)
                        starts.append(begin)
                        lengths.append(end - begin)
                        sums.append(zlib.crc32(raw))
                        if with_ids:
                            out.append(raw)
                arrays = [
                    some.column("doc_id").take(pa.array(rows, pa.int64())),
                    pa.array(numbers, pa.int32()),
                    pa.array(starts, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array(sums, pa.int64()),
                ]
                if with_ids:
                    arrays.append(pa.array(out, pa.binary()))
                yield pa.RecordBatch.from_arrays(arrays, names=[field.name for field in fields])

    return narrow.mapInArrow(encode, T.StructType(fields))
