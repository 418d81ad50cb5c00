"""Attach per-group statistics (one row per group) to every row.

With a group key this is an equi-join in which null keys match each other;
the statistics are computed once, counted, and broadcast only if they are
few.  Without a key, the single statistics row becomes ONE struct-valued
scalar subquery: Spark computes it once and reads the fields as constants -
no join, and in particular no cross join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hotbeat.session import broadcast_if_small, cut_lineage

#: Groups up to which the statistics are broadcast (a few dozen bytes each).
MAX_GROUPS = 500_000


def attach(df: DataFrame, stats: DataFrame, by: list[str]) -> DataFrame:
    """Rows of ``df`` whose group (null included) has statistics, with these beside them."""
    if by:
        keyed = cut_lineage(stats).withColumnsRenamed({c: f"__key_{c}" for c in by})
        small, _ = broadcast_if_small(keyed, MAX_GROUPS)
        same = reduce(lambda a, b: a & b, [df[c].eqNullSafe(keyed[f"__key_{c}"]) for c in by])
        return df.join(small, same).drop(*[f"__key_{c}" for c in by])
    one = stats.select(F.struct(*stats.columns).alias("__s")).scalar()
    return df.select("*", *[one.getField(c).alias(c) for c in stats.columns])
