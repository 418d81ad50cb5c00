"""Flagship query: whole-table cleaning and features, then counts per area and shift."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hotbeat.plans.prepare import enrich, prepare
from hotbeat.sources import fixtures


def incidents_per_area_and_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = enrich(prepare(fixtures.incidents(spark, sf_dir)))
    return (e.groupBy("area", "time_slot")
             .agg(F.count(F.lit(1)).alias("n"),
                  F.countDistinct("crime_category").alias("n_categories"),
                  F.round(F.avg("vict_age"), 6).alias("avg_age"))
             .orderBy("area", "time_slot"))
