"""Great-circle and ellipsoidal distance as column expressions.

``method='sphere'``: haversine on the mean Earth radius.
``method='ellipsoid'``: Andoyer-Lambert first-order flattening correction on
WGS-84, within metres of the geodesic for city-scale distances.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# FIXED VALUES: Earth model.
MEAN_RADIUS_KM = 6371.0088
WGS84_A_KM = 6378.137
WGS84_F = 1 / 298.257223563


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _central_angle(p1, l1, p2, l2) -> Column:
    """Haversine central angle between points given in radians."""
    h = (F.pow(F.sin((p2 - p1) / 2), 2) +
         F.cos(p1) * F.cos(p2) * F.pow(F.sin((l2 - l1) / 2), 2))
    return F.lit(2.0) * F.asin(F.sqrt(F.least(F.lit(1.0), h)))


def geo_km(lat1, lon1, lat2, lon2, method: str = "sphere") -> Column:
    p1, l1 = F.radians(_c(lat1)), F.radians(_c(lon1))
    p2, l2 = F.radians(_c(lat2)), F.radians(_c(lon2))
    if method == "sphere":
        return F.lit(MEAN_RADIUS_KM) * _central_angle(p1, l1, p2, l2)
    if method != "ellipsoid":
        raise ValueError(f"unknown method {method!r}")
    f = WGS84_F
    b1 = F.atan(F.lit(1 - f) * F.tan(p1))
    b2 = F.atan(F.lit(1 - f) * F.tan(p2))
    s = _central_angle(b1, l1, b2, l2)
    P, Q = (b1 + b2) / 2, (b2 - b1) / 2
    x = (s - F.sin(s)) * F.pow(F.sin(P), 2) * F.pow(F.cos(Q), 2) / F.pow(F.cos(s / 2), 2)
    y = (s + F.sin(s)) * F.pow(F.cos(P), 2) * F.pow(F.sin(Q), 2) / F.pow(F.sin(s / 2), 2)
    d = F.lit(WGS84_A_KM) * (s - F.lit(f / 2) * (x + y))
    return F.when(s == 0, F.lit(0.0)).otherwise(d)


def sphere_km_sql(a_lat: str, a_lon: str, b_lat: str, b_lon: str) -> str:
    """Same haversine as SQL text (DuckDB oracle)."""
    return (f"{MEAN_RADIUS_KM} * 2.0 * asin(sqrt(least(1.0, "
            f"pow(sin((radians({b_lat}) - radians({a_lat})) / 2), 2) + "
            f"cos(radians({a_lat})) * cos(radians({b_lat})) * "
            f"pow(sin((radians({b_lon}) - radians({a_lon})) / 2), 2))))")
