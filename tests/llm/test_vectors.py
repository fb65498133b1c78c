"""The vector join against all pairs."""

import numpy as np
import pytest
from conftest import rows_of

from tideline.llm import grid_join

SCHEMA = "vec_id long, embedding array<float>, label int, node string, kept int"


def by_hand(rows, cosine=0.98):
    vectors = []
    for _, vector, label, *_ in rows:
        good = label is not None and vector and all(x is not None and np.isfinite(x) for x in vector)
        vectors.append(np.array(vector, np.float32).astype(float) if good and any(vector) else None)
    parent = list(range(len(rows)))
    links = [0] * len(rows)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(vectors):
        for j in range(i):
            b = vectors[j]
            if a is None or b is None or rows[i][2] != rows[j][2] or len(a) != len(b):
                continue
            if a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= cosine:
                links[i] += 1
                links[j] += 1
                parent[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, row in enumerate(rows):
        if row[0] is not None:
            least[root(i)] = min(least.get(root(i), row[0]), row[0])
    found = []
    for i, row in enumerate(rows):
        component = least.get(root(i))
        found.append((row[0], links[i], component, row[0] == component))
    return sorted(found, key=repr)


def make(draw, n, length, labels, noise):
    centres = draw.normal(size=(40, length))
    return [
        (i, (centres[draw.integers(40)] + noise * draw.normal(size=length)).astype(float).tolist(),
         int(draw.integers(labels)), "x", 1)
        for i in range(n)
    ]


@pytest.mark.parametrize(("length", "noise"), [(3, 0.2), (16, 0.12), (64, 0.09)])
def test_links_and_components(spark, length, noise):
    rows = make(np.random.default_rng(length), 700, length, 3, noise)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    want = by_hand(rows)
    assert any(n for _, n, *_ in want)
    assert rows_of(grid_join.linked(frame, block=32), "vec_id", "n_links", "component_id", "kept") == want


def test_copies_and_odd_vectors(spark):
    rows = make(np.random.default_rng(1), 60, 8, 2, 0.1)
    rows += [(100 + i, *rows[0][1:]) for i in range(200)]
    rows += [(7, *rows[7][1:]), (None, *rows[8][1:]), (None, None, None, None, None)]
    odd = [None, [], [0.0] * 8, [1.0, None] + [0.0] * 6, [float("nan")] * 8, [float("inf")] * 8]
    rows += [(500 + i, vector, 1, "x", 1) for i, vector in enumerate(odd)]
    rows += [(600, rows[0][1], None, "x", 1), (601, rows[0][1][:7], rows[0][2], "x", 1)]
    rows += [(700 + i, [1e-30 * x for x in rows[0][1]], rows[0][2], "x", 1) for i in range(2)]
    rows += [(800 + i, [1e30 * x for x in rows[0][1]], rows[0][2], "x", 1) for i in range(2)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = grid_join.linked(frame, block=16)
    want = by_hand(rows)
    assert rows_of(found, "vec_id", "n_links", "component_id") == sorted(
        [row[:3] for row in want], key=repr
    )


def test_all_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert grid_join.linked(none).count() == 0
    bad = spark.createDataFrame([(1, None, 1, "x", 1), (2, [0.0], 1, "x", 1)], SCHEMA)
    assert rows_of(grid_join.linked(bad)) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_far_blocks_are_skipped(spark):
    """Two far clusters of one label: no pair of blocks across them is compared."""
    draw = np.random.default_rng(2)
    rows = [
        (i, ([1.0, 0.0] if i % 2 else [0.0, 1.0]) + (0.01 * draw.normal(size=6)).tolist(), 1, "x", 1)
        for i in range(640)
    ]
    frame = spark.createDataFrame(rows, SCHEMA)
    nodes = frame.selectExpr("vec_id node", "1L copies", "'1' part", "cast(embedding as array<double>) embedding")
    placed = grid_join._projected(nodes, 0.2, 8)
    numbered = grid_join.ranked(grid_join.settled(placed), ["part"], ["cells", "node"], "_at")
    blocks = grid_join._blocks(numbered.selectExpr("*", "_at div 32 as block"), 8)
    pairs = grid_join._near_blocks(grid_join.settled(blocks.drop("nodes", "copies", "matrix")), 0.2, 8)
    assert blocks.count() == 20
    assert 20 <= pairs.count() <= 2 * (10 * 11 // 2)
