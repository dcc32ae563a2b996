"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _star(directed: DataFrame, larger_only: bool) -> DataFrame:
    """Hangs neighbours of each node on the smallest node around it.

    ``directed`` has (node, neighbour). The smallest is a partial aggregate, so a hub costs no more than its edges; the
    join back to the edges is left to adaptive splitting.
    """
    least = directed.groupBy("node").agg(F.min("neighbour").alias("low")).withColumn("low", F.least("node", "low"))
    joined = directed.join(least.withColumnRenamed("node", "hub"), F.col("node") == F.col("hub"))
    if larger_only:
        return joined.where("neighbour > node").select(F.col("neighbour").alias("a"), F.col("low").alias("b"))
    own = least.select(F.col("node").alias("a"), F.col("low").alias("b"))
    return joined.select(F.col("neighbour").alias("a"), F.col("low").alias("b")).unionByName(own)


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b), where root is the smallest node that can be reached.

    Edges are stored after each pair of steps, so lineage stays short. The steps end when no edge changes, after about
    log2 of the longest path. An edge of a node to itself and repeated edges are allowed; no edges give no rows.
    """
    current = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    seen = None
    while True:
        both = current.select(F.col("a").alias("node"), F.col("b").alias("neighbour")).unionByName(
            current.select(F.col("b").alias("node"), F.col("a").alias("neighbour"))
        )
        large = _star(both, True).where("a <> b").distinct()
        small = _star(large.select(F.col("a").alias("node"), F.col("b").alias("neighbour")), False)
        current = stored(small.where("a <> b").distinct(), "edges")
        # a sum over the hashes of all edges tells a changed set of edges from the same one
        now = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    roots = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
