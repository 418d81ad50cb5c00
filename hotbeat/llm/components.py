"""Connected components by alternating large-star and small-star steps, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hotbeat.llm.common import written


def components(edges: DataFrame, rounds: int | None = None) -> DataFrame:
    """(node, root) of every node of the edges (a, b) that is not itself a root; the root is the least node.

    With a number of ``rounds`` the search may end early: nodes of one root are connected, but a
    component may have several roots yet.

    Each step links nodes to the least neighbour of a neighbour, by a partial aggregate and a join, so
    no neighbour list is ever gathered; each round is written to the shared folder.
    """
    e = (edges.where(F.col("a") != F.col("b"))
         .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before, done = None, 0
    while True:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        large = (both.where(F.col("b") > F.col("a")).join(least, F.col("a") == F.col("u"))
                 .select(F.col("b").alias("a"), F.col("m").alias("b")))
        least = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
        small = (large.join(least, F.col("a") == F.col("u")).where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct())
        e = written(small, "components")
        done += 1
        if rounds:
            if done < rounds:
                continue
            return e.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now
