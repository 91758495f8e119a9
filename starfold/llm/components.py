"""Connected components of a distributed edge list, by alternating stars.

Each round writes its edges to the shared folder, so a lost executor costs at most one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfold.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Point every larger neighbour of a node at the smallest node of its neighbourhood."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lowest = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
    return both.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Point a node and its smaller neighbours at the smallest of them."""
    lowest = edges.groupBy("u").agg(F.min("v").alias("low"))
    moved = edges.join(lowest, "u").where("v > low").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return moved.union(lowest.select("u", F.col("low").alias("v")))


def _state(edges: DataFrame) -> tuple:
    """Number of edges and an order-free digest of them."""
    row = edges.agg(
        F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("v", "u"))
    ).first()
    return tuple(row)


def roots(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (u, v) that is not the smallest of its component.

    The smallest node of a component is its root. Self links and repeated links are allowed; without
    links the result is empty.
    """
    edges = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v")
    edges = stored(edges.distinct(), "edges")
    state = _state(edges)
    while state[0]:
        large = _large_star(edges).where("u > v").distinct()
        edges = stored(_small_star(large).where("u > v").distinct(), "edges")
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
