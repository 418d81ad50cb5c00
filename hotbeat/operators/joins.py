"""Joins around the hotspot table (J3, J4) and a skew-safe top-n per group.

J1 / J2 (code lookups) live in ``functions.codes``; J5 in ``routes``; the
radius and nearest-neighbour joins (J6, J7) in ``spatial``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _as_list(by) -> list[str]:
    if not by:
        return []
    return [by] if isinstance(by, str) else list(by)


def top_n_per_group(df: DataFrame, group, order: Sequence[Column], n: int, salt_cols: Sequence[str],
                    buckets: int = 64, rank_col: str = "rank") -> DataFrame:
    """Exact top-n rows per group without one task per group.

    Phase 1 keeps the top n inside (group, hash bucket of ``salt_cols``) -
    a group of any size spreads over ``buckets`` tasks; phase 2 ranks the
    at most ``buckets * n`` survivors per group.  The top n of a union is
    the top n of the per-part top n's, so the result is exact.
    """
    g = _as_list(group)
    d = df.withColumn("__salt", F.pmod(F.xxhash64(*[F.col(c) for c in salt_cols]), F.lit(buckets)))
    w1 = Window.partitionBy(*g, "__salt").orderBy(*order)
    d = d.withColumn("__r1", F.row_number().over(w1)).filter(F.col("__r1") <= n)
    w2 = Window.partitionBy(*g).orderBy(*order)
    return d.withColumn(rank_col, F.row_number().over(w2)).filter(F.col(rank_col) <= n).drop("__salt", "__r1")


def top_locations(df: DataFrame, by="area", n: int = 10, lat: str = "lat", lon: str = "lon",
                  extra: Sequence[Column] = ()) -> DataFrame:
    """Hotspot candidates: the n most frequent coordinates per group.

    Output (by, hotspot_id 0..n-1, lat, lon, n_incidents, extra aggregates).
    """
    g = _as_list(by)
    c = df.groupBy(*g, lat, lon).agg(F.count(F.lit(1)).alias("n_incidents"), *extra)
    t = top_n_per_group(c, g, [F.desc("n_incidents"), F.asc(lat), F.asc(lon)], n, [lat, lon])
    return t.withColumn("hotspot_id", (F.col("rank") - 1).cast("int")).drop("rank")


def scoring_grid(hotspots: DataFrame, weekdays: int = 7, months: int = 12,
                 weekday_col: str = "occ_weekday", month_col: str = "occ_month") -> DataFrame:
    """Every hotspot x weekday x month (84 rows per hotspot) by ``explode``.

    No join: the calendar is generated per hotspot row.
    """
    return (hotspots.withColumn(weekday_col, F.explode(F.sequence(F.lit(1), F.lit(weekdays))))
                    .withColumn(month_col, F.explode(F.sequence(F.lit(1), F.lit(months)))))


def match_back(scored: DataFrame, hotspots: DataFrame, by="area", id_col: str = "hotspot_id",
               keep: Sequence[str] = ("lat", "lon")) -> DataFrame:
    """Attach hotspot attributes to scored rows by id, never by float equality."""
    g = _as_list(by)
    return scored.join(hotspots.select(*g, id_col, *keep), g + [id_col])
