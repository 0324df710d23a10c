"""Connected components of a graph that fits no single machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimload.sources.scratch import cut_lineage


def _signature(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every end of an edge; the component is its smallest node.

    Alternates two steps until nothing changes: every node's larger neighbours are
    linked to the smallest node it sees, then its smaller ones are. The number of
    rounds grows with the logarithm of the nodes. Each step is a minimum per node
    (combined before the shuffle, so a node with very many links is no burden) and
    an equality join, whose large keys adaptive execution may split. Rounds are cut
    by checkpoints; two numbers a round reach the driver.

    Ends must not be NULL; loops and repeated edges are ignored. No edges: no rows.
    """
    a, b = F.col(a), F.col(b)
    edges = cut_lineage(edges.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct())
    seen = _signature(edges)
    while True:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a != b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(
            F.explode(
                F.array(
                    F.struct(F.col("a"), F.col("m").alias("b")),
                    F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                )
            ).alias("e")
        )
        edges = cut_lineage(small.select("e.*").where("a != b").distinct())
        before, seen = seen, _signature(edges)
        if seen == before:
            break
    leaves = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return leaves.unionAll(roots)
