"""Patrol plan for every area and shift in one job.

hotspots -> scoring grid (hotspot x weekday x month) -> predicted shift
(a fitted pipeline, or the most-frequent-shift baseline) -> shift sets ->
route per (area, shift) -> ordered stops.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hotbeat.operators import classify, joins, routes


def shift_sets(scored: DataFrame, by: str = "area", slot: str = "predicted_slot",
               id_col: str = "hotspot_id") -> DataFrame:
    """Per (area, shift) the hotspots with at least one predicted row.

    ``collect_set`` is bounded by the hotspots per area (k).
    """
    d = scored.select(by, slot, id_col).distinct()
    return (d.groupBy(by, slot).agg(F.sort_array(F.collect_set(id_col)).alias("hotspots"))
             .withColumn("n_hotspots", F.size("hotspots")))


def baseline_scores(enriched: DataFrame, hotspots: DataFrame) -> DataFrame:
    """L11 with the L12 baseline: predicted shift per grid row."""
    grid = joins.scoring_grid(hotspots)
    base = classify.baseline_shift(enriched, ["area", "occ_weekday"])
    return grid.join(base.drop("support"), ["area", "occ_weekday"], "left")


def model_scores(grid: DataFrame, model, slot: str = "predicted_slot") -> DataFrame:
    """L11 with a fitted pipeline (predictions are 0-based -> shift 1..3)."""
    return model.transform(grid).withColumn(slot, (F.col("prediction") + 1).cast("int"))


def plan(scored: DataFrame, hotspots: DataFrame, slot: str = "predicted_slot") -> DataFrame:
    """G2 + G4: ordered stops per (area, shift)."""
    stops = (scored.select("area", slot, "hotspot_id").distinct()
                   .join(hotspots.select("area", "hotspot_id", "lat", "lon"), ["area", "hotspot_id"]))
    r = routes.plan_routes(stops, ["area", slot])
    return routes.route_stops(r, stops, ["area", slot]).join(
        r.select("area", slot, F.col("km").alias("route_km")), ["area", slot])
