"""Hotspots for every area in one job: k-means per area, KDE peak per cluster.

incidents -> ``kmeans(by=area)`` -> ``kde_peak(by=[area, cluster])`` ->
(area, hotspot_id, lat, lon, density, n_incidents, mean_age).  Nothing is
collected; the result feeds the patrol plan directly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hotbeat.operators import density, kmeans


def find_hotspots(enriched: DataFrame, k: int = 10, by: str = "area", grid: int = 100,
                  pad: float = 0.01, seed: int = 42) -> DataFrame:
    labelled = kmeans.kmeans_labels(enriched, ["lat", "lon"], k, by=by, seed=seed)
    peaks = density.kde_peak(labelled, [by, "cluster"], grid, pad)
    ages = labelled.groupBy(by, "cluster").agg(F.avg("vict_age").cast("int").alias("mean_age"))
    return (peaks.join(ages, [by, "cluster"], "left")
                 .select(by, F.col("cluster").alias("hotspot_id"), F.col("peak_lat").alias("lat"),
                         F.col("peak_lon").alias("lon"), "density", F.col("n").alias("n_incidents"), "mean_age"))
