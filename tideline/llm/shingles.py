"""Hashed word shingles of many texts at once, on arrays of bytes."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np

from ..session import ship_by_value
from .kept import once

ship_by_value(__name__)

#: Words of a shingle.
WORDS = 5
#: Bytes of text that are worked on at once (more only for a single longer text).
AT_ONCE = 1 << 19
#: Bits of a shingle's hash beside its document's number.
HASH_BITS = 48
_BASE = 0x5851F42D4C957F2D
_FACTORS = (
    0x9E3779B97F4A7C15,
    0xC2B2AE3D27D4EB4F,
    0x165667B19E3779F9,
    0xD6E8FEB86659FD93,
    0xA0761D6478BD642F,
)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of splitmix64)."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""

    def run(base: int) -> np.ndarray:
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        return np.cumprod(steps, dtype=np.uint64)

    return run(_BASE), run(pow(_BASE, -1, 1 << 64))


@dataclass
class Bags:
    """Multisets of shingles: rows first..last of ``keys`` and ``weights`` for each document."""

    bounds: np.ndarray
    rows: np.ndarray
    keys: np.ndarray
    weights: np.ndarray


def chunks(texts: Sequence[str | None], at_once: int = AT_ONCE) -> Iterator[tuple[int, list[bytes]]]:
    """Lower-case bytes of consecutive texts, about ``at_once`` bytes at a time."""
    first, part, size = 0, [], 0
    for i, text in enumerate(texts):
        raw = text.lower().encode("utf-8", "surrogatepass") if text else b""
        if part and (size + len(raw) > at_once or len(part) >= 4096):
            yield first, part
            first, part, size = i, [], 0
        part.append(raw)
        size += len(raw)
    if part:
        yield first, part


def bags(raws: list[bytes], words: int = WORDS) -> Bags:
    """The shingles of each text with their multiplicity.

    A text with fewer words than a shingle has one shingle of all its words, a text without
    words has none.
    """
    data = np.frombuffer(b" ".join(raws) + b" ", np.uint8)
    bounds = np.cumsum([0, *(len(raw) + 1 for raw in raws)])
    size = 1 << max(20, int(len(data)).bit_length())
    # larger sizes, for single long texts, are not worth keeping
    power, inverse = once("powers", lambda: _powers(size)) if size == 1 << 20 else _powers(size)
    solid = (data != 32) & ((data < 9) | (data > 13))
    edges = np.flatnonzero(np.diff(solid.astype(np.int8), prepend=0))
    starts, ends = edges[::2], edges[1::2]
    terms = (data.astype(np.uint64) + np.uint64(1)) * power[: len(data)]
    sums = np.concatenate([[np.uint64(0)], np.cumsum(terms, dtype=np.uint64)])
    word = (sums[ends] - sums[starts]) * inverse[starts]
    word = mixed(word ^ (ends - starts).astype(np.uint64) * np.uint64(_FACTORS[0]))
    row = np.searchsorted(bounds, starts, "right") - 1
    n = len(word)
    shingle = np.zeros(n, np.uint64)
    padded = np.concatenate([word, np.zeros(words, np.uint64)])
    rows = np.concatenate([row, np.full(words, -1)])
    for k in range(words):
        same = rows[k : k + n] == row
        factor = np.uint64(_FACTORS[k % len(_FACTORS)] + 2 * (k // len(_FACTORS)))
        shingle += np.where(same, padded[k : k + n] * factor, np.uint64(0))
    first = np.ones(n, bool)
    first[1:] = row[1:] != row[:-1]
    whole = (rows[words - 1 : words - 1 + n] == row) | first
    hashes = mixed(shingle[whole]) >> np.uint64(64 - HASH_BITS)
    keys = (row[whole].astype(np.uint64) << np.uint64(HASH_BITS)) | hashes
    keys.sort()
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    at = np.flatnonzero(new)
    weights = np.diff(np.append(at, len(keys)))
    keys = keys[at]
    owner = (keys >> np.uint64(HASH_BITS)).astype(np.int64)
    return Bags(
        np.searchsorted(owner, np.arange(len(raws) + 1)),
        owner,
        keys & np.uint64((1 << HASH_BITS) - 1),
        weights,
    )
