"""Spatial joins and grids.

Design for scale:
* Incidents repeat coordinates heavily (one block centroid can hold a large
  share of all rows).  Every spatial operator first collapses rows to
  *weighted distinct points* with a ``groupBy`` whose partial aggregation
  runs map-side, so a hot coordinate never reaches a single task as rows.
* Range predicates become equi-joins on integer grid cells: each point is
  replicated to the 3x3 neighbour cells on the probe side, joined on
  ``(by, cell)`` and filtered by the exact distance.  No cartesian product.
* Global ranks use range partitioning plus per-partition offsets instead of
  an unpartitioned window.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hotbeat.session import cut_lineage


def _cols(c) -> list[str]:
    if c is None:
        return []
    return [c] if isinstance(c, str) else list(c)


def weighted_points(df: DataFrame, by=None, x: str = "lat", y: str = "lon",
                    id_col: str = "incident_id") -> DataFrame:
    """Collapse rows to distinct (by, x, y) with weight ``w`` and id ``pid``."""
    return (df.groupBy(*_cols(by), x, y)
              .agg(F.count(F.lit(1)).alias("w"), F.min(id_col).alias("pid")))


def sq_dist(ax: Column, ay: Column, bx: Column, by_: Column) -> Column:
    """Squared Euclidean distance, written exactly as in the SQL oracles."""
    return (ax - bx) * (ax - bx) + (ay - by_) * (ay - by_)


def with_cells(pts: DataFrame, size: float, x: str = "lat", y: str = "lon") -> DataFrame:
    return (pts.withColumn("cx", F.floor(F.col(x) / F.lit(size)))
               .withColumn("cy", F.floor(F.col(y) / F.lit(size))))


def _ring_offsets(r: int) -> Column:
    offs = [F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy"))
            for dx in range(-r, r + 1) for dy in range(-r, r + 1)]
    return F.explode(F.array(*offs))


def radius_pairs(pts: DataFrame, eps: float, by=None, x: str = "lat", y: str = "lon",
                 payload: Sequence[str] = ("w",)) -> DataFrame:
    """All (p, q) with |p - q| <= eps inside the same ``by`` group.

    Output: ``by``, ``p`` (pid), ``q`` (pid) and ``q_<payload>`` columns; the
    self pair is included.  Points must be distinct per (by, x, y) and carry
    ``pid``.  Work is proportional to the number of neighbour pairs, which
    the weighted collapse keeps near-linear for repeated coordinates.
    """
    by = _cols(by)
    a = with_cells(pts, eps, x, y).select(*by, "cx", "cy", F.col("pid").alias("p"),
                                          F.col(x).alias("ax"), F.col(y).alias("ay"))
    b = (with_cells(pts, eps, x, y)
         .select(*by, "cx", "cy", F.col("pid").alias("q"), F.col(x).alias("bx"), F.col(y).alias("by_"),
                 *[F.col(c).alias(f"q_{c}") for c in payload])
         .withColumn("o", _ring_offsets(1))
         .withColumn("cx", F.col("cx") + F.col("o.dx"))
         .withColumn("cy", F.col("cy") + F.col("o.dy")).drop("o"))
    j = a.join(b, by + ["cx", "cy"])
    j = j.filter(sq_dist(F.col("ax"), F.col("ay"), F.col("bx"), F.col("by_")) <= F.lit(eps) * F.lit(eps))
    return j.select(*by, "p", "q", "ax", "ay", "bx", "by_", *[f"q_{c}" for c in payload])


def neighbour_weight(pts: DataFrame, eps: float, by=None, x: str = "lat", y: str = "lon") -> DataFrame:
    """Weight of all rows within eps of each distinct point (self included)."""
    pr = radius_pairs(pts, eps, by, x, y)
    return pr.groupBy(*_cols(by), "p").agg(F.sum("q_w").alias("nw"), F.count(F.lit(1)).alias("n_points"))


def _levels(pts: DataFrame, cell: float, top: int) -> DataFrame:
    """Each point once a level: its cell of side cell * 2^level."""
    side = F.lit(cell) * F.pow(F.lit(2.0), F.col("lv"))
    return (pts.withColumn("lv", F.explode(F.sequence(F.lit(0), F.lit(top))))
               .withColumn("lx", F.floor(F.col("__x") / side)).withColumn("ly", F.floor(F.col("__y") / side)))


def knn_distance(pts: DataFrame, k: int, cell: float, by=None, x: str = "lat",
                 y: str = "lon") -> DataFrame:
    """Distance from each distinct point to its k-th nearest row (self counted).

    Rows at the same coordinate count with their weight, so a point of
    weight >= k has distance 0.  Groups whose total weight is below k get
    null.  Output: ``by``, ``pid``, ``x``, ``y``, ``w``, ``kdist``.

    Cells double in size from level to level.  A point's level is the first
    at which the 3 x 3 cells around it weigh k or more; its k nearest rows
    are then no farther than 2 sqrt(2) sides, so only the 7 x 7 cells of that
    level are looked at.  One pass whatever the spacing of the points: a far
    point just sits on a high level.
    """
    by = _cols(by)
    if not by:
        pts, by = pts.withColumn("__g", F.lit(0)), ["__g"]
    keep = pts.select(*by, "pid", x, y, "w")
    p = cut_lineage(keep.select(*by, "pid", "w", F.col(x).cast("double").alias("__x"), F.col(y).cast("double").alias("__y")))
    span = p.groupBy(*by).agg((F.max("__x") - F.min("__x")).alias("a"), (F.max("__y") - F.min("__y")).alias("b"))
    widest = span.agg(F.max(F.greatest("a", "b"))).first()[0] or 0.0
    top = max(0, math.ceil(math.log2(max(widest / cell, 1.0)))) + 1
    at = [*by, "lv", "lx", "ly"]
    every = _levels(p, cell, top)
    cells = every.groupBy(*at).agg(F.sum("w").alias("cw"))
    block = (cells.withColumn("o", _ring_offsets(1)).withColumn("lx", F.col("lx") + F.col("o.dx")).withColumn("ly", F.col("ly") + F.col("o.dy"))
             .groupBy(*at).agg(F.sum("cw").alias("bw")).filter(F.col("bw") >= k).select(*at))
    level = cut_lineage(every.join(block, at).groupBy(*by, "pid").agg(F.min("lv").alias("lv")))
    side = F.lit(cell) * F.pow(F.lit(2.0), F.col("lv"))
    probe = (p.join(level, [*by, "pid"]).withColumn("o", _ring_offsets(3))
              .withColumn("lx", F.floor(F.col("__x") / side) + F.col("o.dx")).withColumn("ly", F.floor(F.col("__y") / side) + F.col("o.dy")))
    used = level.select(*by, "lv").distinct()  # levels of a group that some point needs
    there = every.join(used, [*by, "lv"]).select(*at, F.col("__x").alias("bx"), F.col("__y").alias("by_"), F.col("w").alias("bw"))
    d = (probe.join(there, at)
         .select(*by, "pid", F.sqrt(sq_dist(F.col("__x"), F.col("__y"), F.col("bx"), F.col("by_"))).alias("d"), "bw",
                 (F.lit(2.8285) * side).alias("far")).filter(F.col("d") <= F.col("far")))
    w = Window.partitionBy(*by, "pid").orderBy("d").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    kd = (d.withColumn("cw", F.sum("bw").over(w)).filter(F.col("cw") >= k)
           .groupBy(*by, "pid").agg(F.min("d").alias("kdist")))
    return keep.join(kd, [*by, "pid"], "left").select(*by, "pid", x, y, "w", "kdist").drop("__g")


def exact_rank(df: DataFrame, order: Sequence[str], out: str = "rank",
               partitions: int | None = None) -> DataFrame:
    """Exact 1-based global rank by ``order`` without a single-partition window.

    Range-partition on the order keys (ties spread because the last key is
    unique), count rows per partition, prefix-sum those few counts, and add
    the offset to a per-partition ``row_number``.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    r = cut_lineage(df.repartitionByRange(n, *order).withColumn("__part", F.spark_partition_id()))
    counts = r.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    offs = counts.withColumn("__off", F.sum("__n").over(
        Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))).fillna(0, ["__off"])
    local = r.withColumn("__local", F.row_number().over(Window.partitionBy("__part").orderBy(*order)))
    # ``offs`` has one row per shuffle partition: bounded by configuration.
    return (local.join(F.broadcast(offs.select("__part", "__off")), "__part")
                 .withColumn(out, F.col("__local") + F.col("__off"))
                 .drop("__part", "__local", "__off"))


def kdistance_curve(pts: DataFrame, k: int, cell: float, by=None, x: str = "lat", y: str = "lon") -> DataFrame:
    """K-distance of every distinct point with its exact sorted rank."""
    kd = knn_distance(pts, k, cell, by, x, y).filter(F.col("kdist").isNotNull())
    return exact_rank(kd, ["kdist", "pid"])


def heat_grid(df: DataFrame, cell: float, by=None, x: str = "lat", y: str = "lon") -> DataFrame:
    """Point counts per grid cell (bounded output, what a heat layer draws)."""
    return (df.groupBy(*_cols(by), F.floor(F.col(x) / F.lit(cell)).alias("gx"),
                       F.floor(F.col(y) / F.lit(cell)).alias("gy"))
              .agg(F.count(F.lit(1)).alias("n")))
