"""Univariate outlier rules (M1, M2); M3 is density noise (see ``dbscan``).

Bounds are one aggregate row per group, joined back on the group key; the
fact side is never shuffled for it (the bounds side is broadcast - its size
is the number of groups, bounded by the caller's key).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hotbeat.operators.attach import attach
from hotbeat.operators.quantiles import exact_quantiles


def _group(df: DataFrame, by):
    return df, ([] if not by else [by] if isinstance(by, str) else list(by))


def quartile_outliers(df: DataFrame, cols: Sequence[str], method: str = "iqr", by=None,
                      k: float = 1.5) -> DataFrame:
    """M1: rows outside [q25 - k*s, q75 + k*s] in any column.

    ``method='iqr'``: s = q75 - q25 (true IQR).  ``method='qstd'``: s = sample
    standard deviation, the rule as the source workflow wrote it (Q15).
    Quartiles are exact with linear interpolation, found by selection
    (``quantiles``): no task holds the values of a group or a column.
    """
    if method not in ("iqr", "qstd"):
        raise ValueError(method)
    d, g = _group(df, by)
    b = exact_quantiles(d, cols, [0.25, 0.75], g)
    b = b.select(*g, *[F.col(f"q_{c}")[i].alias(f"__q{q}_{c}") for c in cols for i, q in enumerate((1, 3))])
    out = attach(d, b, g)
    if method == "qstd":
        out = attach(out, d.groupBy(*g).agg(*[F.stddev_samp(c).alias(f"__sd_{c}") for c in cols]), g)
    cond = F.lit(False)
    for c in cols:
        q1, q3 = F.col(f"__q1_{c}"), F.col(f"__q3_{c}")
        s = (q3 - q1) if method == "iqr" else F.col(f"__sd_{c}")
        cond = cond | (F.col(c) < q1 - k * s) | (F.col(c) > q3 + k * s)
    return out.filter(cond).select(*d.columns)


def zscore_outliers(df: DataFrame, cols: Sequence[str], threshold: float = 3.0, by=None) -> DataFrame:
    """M2: rows with |x - mean| / population sd > threshold in any column.

    A column without spread in a group has no outliers there.
    """
    d, g = _group(df, by)
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"__m_{c}"), F.stddev_pop(c).alias(f"__s_{c}")]
    b = d.groupBy(*g).agg(*aggs)
    cond = F.lit(False)
    for c in cols:
        cond = cond | (F.coalesce(F.abs(F.col(c) - F.col(f"__m_{c}")) / F.nullif(F.col(f"__s_{c}"), F.lit(0.0)) > threshold, F.lit(False)))
    out = attach(d, b, g).filter(cond)
    return out.drop(*[x for x in b.columns if x.startswith("__")])
