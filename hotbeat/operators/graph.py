"""Connected components over an edge DataFrame (used by DBSCAN).

Alternating large-star and small-star steps: every node is linked to the
least neighbour of a neighbour by a partial aggregate and a join on the node,
so neither a component nor a neighbour list is ever one key or one value.
The number of rounds grows with the logarithm of the longest path; each is
cut with a reliable checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hotbeat.session import cut_lineage


def _star(edges: DataFrame) -> DataFrame:
    """(a, b), a > b: each node beside its least neighbour's links."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
    large = (both.filter(F.col("b") > F.col("a")).join(least, F.col("a") == F.col("u"))
             .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
    least = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
    return (large.join(least, F.col("a") == F.col("u")).filter(F.col("b") != F.col("m"))
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct())


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """nodes(node), edges(src, dst) -> (node, label = smallest node id in its component).

    Edges are undirected; every node appears in the output.
    """
    e = (edges.filter(F.col("src") != F.col("dst"))
              .select(F.greatest("src", "dst").alias("a"), F.least("src", "dst").alias("b")).distinct())
    before = None
    while True:
        e = cut_lineage(_star(e))
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return (nodes.select("node").distinct().join(e.withColumnsRenamed({"a": "node", "b": "label"}), "node", "left")
                 .withColumn("label", F.coalesce("label", "node")))
