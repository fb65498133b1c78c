"""Signatures of weighted sets."""

from __future__ import annotations

import numpy as np

from ..session import ship_by_value
from .shingles import Bags, mixed

ship_by_value(__name__)

_STEP = np.uint64(0x9E3779B97F4A7C15)


def signatures(bags: Bags, documents: int, size: int) -> np.ndarray:
    """BagMinHash: a row of ``size`` values per document; two documents agree in a value with the
    probability of their weighted Jaccard similarity. Documents without elements have infinity.

    Each element owns Poisson processes over time, one for each of the weight intervals (0, 1],
    (1, 2], (2, 4], (4, 8], ... that its weight reaches into, with the interval's length as rate;
    weights are whole, so this grid holds them exactly. A point has a random component of the
    signature and a whole weight, evenly drawn from the interval; it counts if the element's weight
    covers that. Of the interval that a weight ends in, the points above it are drawn and passed
    over, fewer than half on average. The signature has the earliest time of each component. Points are made in order
    of time and an element stops once its time is past all components of its document, so the
    work per document follows elements + size * log(size), not the sum of weights.
    """
    found = np.full((documents, size), np.inf)
    flat = found.reshape(-1)
    weight = bags.weights.astype(np.int64)
    # one entry per element and interval: interval 0 has length 1, interval k has 2^(k-1)
    reach = np.ceil(np.log2(np.maximum(weight, 1))).astype(np.int64) + 1
    pick = np.repeat(np.arange(len(weight)), reach)
    level = np.arange(len(pick)) - np.repeat(np.cumsum(reach) - reach, reach)
    low = np.where(level > 0, 1 << np.maximum(level - 1, 0), 0)
    span = np.where(level > 0, low, 1)
    row, weight = bags.rows[pick], weight[pick]
    seed = mixed(bags.keys[pick] * _STEP + level.astype(np.uint64))
    time = np.zeros(len(pick))
    while len(row):
        seed = seed + _STEP
        draw = mixed(seed)
        time = time - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / span
        other = mixed(draw ^ np.uint64(0xD1B54A32D192ED03))
        part = ((other >> np.uint64(32)) * np.uint64(size)) >> np.uint64(32)
        at = low + (other & np.uint64(0xFFFFFFFF)).astype(np.int64) % span
        covered = at < weight
        cell = row * size + part.astype(np.int64)
        np.minimum.at(flat, cell[covered], time[covered])
        latest = found.max(axis=1)
        go = time < latest[row]
        row, weight, seed = row[go], weight[go], seed[go]
        time, low, span = time[go], low[go], span[go]
    return found
