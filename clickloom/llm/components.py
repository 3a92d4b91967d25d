"""Connected components of a graph given as edges, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.sinks import scratch


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest neighbour."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least"))
    return (
        both.join(least, "a")
        .filter(F.col("b") > F.col("a"))
        .select(F.col("b").alias("a"), F.least("a", "least").alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    tied = down.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return (
        tied.unionAll(least.select("a", F.col("least").alias("b")))
        .filter(F.col("a") > F.col("b"))
        .distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """node and component (its smallest node) of every node of ``edges`` (a, b); loops are ignored.

    Each round halves the distance to the smallest node or better, so there are about as many rounds as the logarithm
    of the longest path. Every round is written to the shared folder. No rows reach the driver but a count and a checksum.
    """
    given = scratch.written(edges.filter(F.col("a") != F.col("b")).distinct(), "edges")
    current, before = given, None
    while True:
        current = scratch.written(_small_star(_large_star(current)), "stars")
        state = current.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if state == before:
            break
        before = state
    nodes = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return nodes.unionAll(roots)
