"""Connected components of a graph given by its links, by alternating star contractions.

Each round only joins links with the smallest neighbour of a node and counts what is left; links
stay distributed. A node with very many links is split over tasks by adaptive skew joins, and its
smallest neighbour is found by partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import compact, settled


def _links(first: str, second: str) -> list:
    return [F.col(first).alias("u"), F.col(second).alias("v")]


def _are_stars(links: DataFrame) -> bool:
    """Whether each node is linked to one root, which is linked to no lesser node itself."""
    ends = links.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.unionByName(
        links.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    counted = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return counted.where("up > 1 or (up = 1 and down = 1)").isEmpty()


def components(links: DataFrame, first: str, second: str) -> DataFrame:
    """(node, root) for every node of a link, root being the smallest node it is connected to.

    Nodes are numbers. Links may repeat, in either direction; a link of a node with itself says
    nothing.
    """
    greater, lesser = F.greatest(first, second), F.least(first, second)
    pairs = links.select(greater.alias("u"), lesser.alias("v")).where("u > v")
    links = settled(pairs.distinct())
    n = links.count()
    links = compact(links, n)

    def least(rows: DataFrame) -> DataFrame:
        return settled(compact(rows.groupBy("u").agg(F.min("v").alias("least")), n))

    while not _are_stars(links):
        # large star: each greater neighbour of a node is linked to the node's least neighbour
        both = links.unionByName(links.select(*_links("v", "u")))
        greater_ones = both.join(least(both), "u").where("v > u")
        moved = greater_ones.select(F.col("v").alias("u"), F.least("u", "least").alias("v"))
        large = settled(compact(moved.distinct(), n))
        # small star: a node and its lesser neighbours are linked to the least of them
        lowest = least(large)
        moved = large.join(lowest, "u").where("v > least").select(*_links("v", "least"))
        ends = lowest.select(*_links("u", "least"))
        links = settled(compact(moved.unionByName(ends).distinct(), n))
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
