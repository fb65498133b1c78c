"""Vectors of one label that are close by cosine, by an epsilon grid order join.

Unit vectors with cosine >= t lie within epsilon = sqrt(2 - 2 t). They are projected on their
leading principal directions, which never lengthens a distance, and sorted by the cells of a grid
of side epsilon in that space. The sequence of each label is cut into blocks of bounded size;
sequence intervals are joined recursively from whole sequences down to single blocks, and a pair
of intervals whose bounding boxes are farther apart than epsilon is dropped with all below it.
Blocks that remain are compared as matrices inside the tasks, in double precision.

Equal vectors of a label are one node with a count, so copies are not compared. A compared pair
of blocks returns, for each vector with links, their number and a representative that it is
connected to: no pair of vectors is ever emitted, and component search gets at most one link per
vector and block pair.

Defined results: vectors that are null, empty or zero, or hold null or non-finite components, and
vectors without label, link with nothing; vectors of different lengths do not link; repeated rows
are vectors of their own that link with each other; null ids are passed over when the smallest id
is sought; an empty table gives an empty result. Other columns play no part and may have any name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_by_value
from .common import join_groups, landed, ranked, settled
from .components import components

ship_by_value(__name__)

COSINE = 0.98
#: Leading principal directions that span the grid.
DIRECTIONS = 8
#: Vectors of a block.
BLOCK = 256
#: Guards the box test against rounding.
SLACK = 1e-9


def _units(matrix: np.ndarray) -> np.ndarray:
    # scaled first, so that squares neither overflow nor vanish
    matrix = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return matrix / np.linalg.norm(matrix, axis=1, keepdims=True)


def _by_length(batch: pa.RecordBatch, column: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and matrix of the vectors of each length."""
    vectors = batch.column(column)
    lengths = np.diff(vectors.offsets.to_numpy())
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    starts = np.cumsum(lengths) - lengths
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        yield rows, values[starts[rows][:, None] + np.arange(length)]


def principal_directions(nodes: DataFrame, directions: int) -> dict[int, np.ndarray]:
    """The leading eigenvectors of the second moments of all unit vectors, for each length.

    Tasks add up their products; what is collected has length^2 rows.
    """

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, matrix in _by_length(batch, "embedding"):
                units = _units(matrix)
                length = units.shape[1]
                sums[length] = sums.get(length, 0) + units.T @ units
        for length, total in sums.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(total.size, length)),
                    pa.array(np.arange(total.size)),
                    pa.array(total.reshape(-1)),
                ],
                ["length", "cell", "total"],
            )

    found = nodes.select("embedding").mapInArrow(products, "length long, cell long, total double")
    rows = found.groupBy("length", "cell").agg(F.sum("total").alias("total")).collect()
    moments: dict[int, np.ndarray] = {}
    for row in rows:
        length = row["length"]
        moments.setdefault(length, np.zeros(length * length))[row["cell"]] = row["total"]
    return {
        length: np.linalg.eigh(total.reshape(length, length))[1][:, ::-1][:, :directions]
        for length, total in moments.items()
    }


def _projected(nodes: DataFrame, epsilon: float, directions: int) -> DataFrame:
    """Add place (coordinates in the leading directions) and cells (of the grid)."""
    bases = principal_directions(nodes, directions)
    schema = T.StructType(
        [
            *nodes.schema.fields,
            T.StructField("place", T.ArrayType(T.DoubleType())),
            T.StructField("cells", T.ArrayType(T.IntegerType())),
        ]
    )

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = np.zeros((batch.num_rows, directions))
            for rows, matrix in _by_length(batch, "embedding"):
                base = bases[matrix.shape[1]]
                places[rows, : base.shape[1]] = _units(matrix) @ base
            cells = np.floor(places / epsilon).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(list(places), pa.list_(pa.float64())),
                    pa.array(list(cells), pa.list_(pa.int32())),
                ],
                names=schema.names,
            )

    return nodes.mapInArrow(project, schema)


def _blocks(placed: DataFrame, directions: int) -> DataFrame:
    """One row per block: part (of equal label and length), block, nodes, copies, matrix, box."""
    corners = [f"{side}{i}" for side in ("low", "high") for i in range(directions)]
    schema = "part string, block long, nodes binary, copies binary, matrix binary, " + ", ".join(
        f"{corner} double" for corner in corners
    )

    def gather(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        places = np.vstack(rows["place"].to_list())
        box = np.concatenate([places.min(axis=0), places.max(axis=0)])
        row = {
            "part": key[0],
            "block": key[1],
            "nodes": rows["node"].to_numpy("<i8").tobytes(),
            "copies": rows["copies"].to_numpy("<i8").tobytes(),
            "matrix": np.vstack(rows["embedding"].to_list()).astype("<f8").tobytes(),
        }
        return pd.DataFrame([row | dict(zip(corners, box))])

    return placed.groupBy("part", "block").applyInPandas(gather, schema)


def _near_blocks(boxes: DataFrame, epsilon: float, directions: int) -> DataFrame:
    """Pairs (part, one <= other) of blocks whose boxes are within epsilon, found level by level:
    intervals of 2^level blocks, their pairs split in halves while they may be near."""
    blocks = boxes.agg(F.max("block")).first()[0]
    levels = 0 if blocks is None else int(blocks).bit_length()
    pairs = boxes.select("part").distinct().select(
        "part", F.lit(0).cast("long").alias("one"), F.lit(0).cast("long").alias("other")
    )
    limit = epsilon * epsilon * (1 + SLACK) + SLACK
    for level in range(levels, -1, -1):
        sums = [F.min(f"low{i}").alias(f"low{i}") for i in range(directions)]
        sums += [F.max(f"high{i}").alias(f"high{i}") for i in range(directions)]
        box = boxes.groupBy("part", F.shiftright("block", level).alias("at")).agg(*sums)
        names = [name for name in box.columns if name not in ("part", "at")]
        first = box.select("part", F.col("at").alias("one"), *[F.col(n).alias(f"a_{n}") for n in names])
        second = box.select("part", F.col("at").alias("other"), *[F.col(n).alias(f"b_{n}") for n in names])
        gaps = [
            F.greatest(
                F.lit(0.0),
                F.col(f"a_low{i}") - F.col(f"b_high{i}"),
                F.col(f"b_low{i}") - F.col(f"a_high{i}"),
            )
            for i in range(directions)
        ]
        distance = sum((gap * gap for gap in gaps), F.lit(0.0))
        near = pairs.join(first, ["part", "one"]).join(second, ["part", "other"]).where(distance <= limit)
        pairs = settled(near.select("part", "one", "other"))
        if level:
            halves = F.explode(F.expr("array(0L, 1L)"))
            pairs = (
                pairs.withColumn("_i", halves)
                .withColumn("_j", F.explode(F.expr("array(0L, 1L)")))
                .select(
                    "part",
                    (F.col("one") * 2 + F.col("_i")).alias("one"),
                    (F.col("other") * 2 + F.col("_j")).alias("other"),
                )
                .where("one <= other")
            )
    return pairs


def _roots(hits: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row and column of a matrix of links, the smallest node it is connected to."""
    none = np.iinfo(np.int64).max
    rows, columns = left.copy(), right.copy()
    while True:
        for_rows = np.minimum(rows, np.where(hits, columns[None, :], none).min(axis=1))
        for_columns = np.minimum(columns, np.where(hits, for_rows[:, None], none).min(axis=0))
        if (for_rows == rows).all() and (for_columns == columns).all():
            return rows, columns
        rows, columns = for_rows, for_columns


def _compared(pairs: DataFrame, blocks: DataFrame, cosine: float) -> DataFrame:
    """(node, links, root) for each vector with links in each pair of blocks."""
    columns = ["nodes", "copies", "matrix"]
    first = blocks.select(
        "part", F.col("block").alias("one"), *[F.col(c).alias(f"a_{c}") for c in columns]
    )
    second = blocks.select(
        "part", F.col("block").alias("other"), *[F.col(c).alias(f"b_{c}") for c in columns]
    )
    met = pairs.join(first, ["part", "one"]).join(second, ["part", "other"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                same = row["one"] == row["other"]
                left, right = (np.frombuffer(row[f"{s}_nodes"], "<i8") for s in "ab")
                a = np.frombuffer(row["a_matrix"], "<f8").reshape(len(left), -1)
                b = np.frombuffer(row["b_matrix"], "<f8").reshape(len(right), -1)
                hits = _units(a) @ _units(b).T >= cosine
                if same:
                    np.fill_diagonal(hits, False)
                if not hits.any():
                    continue
                at, to = _roots(hits, left, right)
                found = [(left, hits @ np.frombuffer(row["b_copies"], "<i8"), at)]
                if not same:
                    found.append((right, hits.T @ np.frombuffer(row["a_copies"], "<i8"), to))
                for nodes, links, roots in found:
                    some = links > 0
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(nodes[some]), pa.array(links[some]), pa.array(roots[some])],
                        ["node", "links", "root"],
                    )

    columns = [f"{side}_{c}" for side in "ab" for c in columns]
    return met.select("one", "other", *columns).mapInArrow(
        compare, "node long, links long, root long"
    )


def linked(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    cosine: float = COSINE,
    directions: int = DIRECTIONS,
    block: int = BLOCK,
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    epsilon = math.sqrt(2 - 2 * cosine)
    inner = F.col(embedding).cast("array<double>")
    finite = F.forall(inner, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = (
        F.col(label).isNotNull() & inner.isNotNull() & finite & F.exists(inner, lambda x: x != 0)
    )
    rows = settled(
        vectors.select(
            F.col(vec_id).alias("vec_id"),
            F.when(usable, F.struct(F.col(label).alias("label"), inner.alias("embedding"))).alias("same"),
            F.monotonically_increasing_id().alias("row"),
        )
    )
    nodes = settled(
        rows.where("same is not null")
        .groupBy("same")
        .agg(F.min("row").alias("node"), F.count("*").alias("copies"))
    )
    part = F.concat(F.col("same.label").cast("string"), F.lit("/"), F.size("same.embedding"))
    placed = _projected(
        nodes.select("node", "copies", part.alias("part"), "same.embedding"), epsilon, directions
    )
    numbered = ranked(settled(placed), ["part"], ["cells", "node"], "_at")
    blocks = landed(
        _blocks(numbered.withColumn("block", F.expr(f"_at div {block}")), directions), "blocks"
    )
    pairs = _near_blocks(blocks.drop("nodes", "copies", "matrix"), epsilon, directions)
    found = settled(_compared(pairs, blocks, cosine))
    roots = components(found, "node", "root")
    counted = found.groupBy("node").agg(F.sum("links").alias("links"))
    known = settled(
        nodes.join(counted, "node", "left")
        .join(roots, "node", "left")
        .select(
            "same",
            "copies",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("root", "node").alias("root"),
        )
    )
    some = join_groups(rows.where("same is not null"), known, "same", "copies")
    none = rows.where("same is null").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("row").alias("root")
    )
    members = settled(some.select("vec_id", "n_links", "root").unionByName(none))
    groups = settled(
        members.groupBy("root").agg(F.min("vec_id").alias("component_id"), F.count("*").alias("n"))
    )
    return join_groups(members, groups, "root", "n").select(
        "vec_id",
        "n_links",
        "component_id",
        F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )
