"""Exact quantiles of many columns and groups by selection (used by A16, M1).

A wanted rank is narrowed to the value range that holds it: each round counts
the rows of every open range in ``BINS`` bins (a partial aggregate, so only
counts are shuffled) and keeps the bin with the rank.  A range is closed once
it holds a single value or at most ``SORTED`` rows; then its values alone are
counted and put in order.  Nothing holds all values of a column or a group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hotbeat.operators.attach import attach
from hotbeat.session import cut_lineage

#: Value ranges counted per open range and round.
BINS = 1024
#: Rows of a range up to which its values are put in order.
SORTED = 1_000_000
#: Largest finite double.
LARGEST = 1.7976931348623157e308

_KEY = ["__g", "__c"]
_RANGE = [*_KEY, "__lo", "__hi"]


def _bin(v: Column, lo: Column, hi: Column) -> Column:
    """Bin of v in [lo, hi], rising with v; lo and hi have bins of their own, so every round gains."""
    low, high = F.greatest(lo, F.lit(-LARGEST)) / 2, F.least(hi, F.lit(LARGEST)) / 2
    place = F.coalesce(F.try_divide(v / 2 - low, high - low), F.lit(0.0)) * (BINS - 2)
    inner = F.floor(F.greatest(F.least(place, F.lit(BINS - 3.0)), F.lit(0.0))).cast("int") + 1
    return F.when(v <= lo, 0).when(v >= hi, BINS - 1).otherwise(inner)


def _in_ranges(rows: DataFrame, ranges: DataFrame, key: list[str]) -> DataFrame:
    """Each value of ``rows`` (group, array of values) once for every wanted range it lies in."""
    one = F.collect_set(F.struct("__c", "__lo", "__hi")).alias("__ranges")
    lists = ranges.groupBy(*key).agg(one) if key else ranges.agg(one)
    held = F.filter("__ranges", lambda r: F.get("__v", r["__c"]).between(r["__lo"], r["__hi"]))
    held = attach(rows, lists, key).select("__g", "__v", F.explode(held).alias("__r"))
    return held.select("__g", "__r.*", F.get("__v", F.col("__r.__c")).alias("__v"))


def _narrowed(wanted: DataFrame, counted: DataFrame, order: str) -> DataFrame:
    """Each wanted rank in the counted part of its range that holds it (parts a range: bounded)."""
    w = Window.partitionBy(*_RANGE).orderBy(order)
    parts = counted.withColumn("__before", F.sum("__n").over(w) - F.col("__n"))
    parts = parts.select(*[F.col(c).alias(f"__p{c}") for c in _RANGE], "__before", "__n", "__mn", "__mx")
    same = [F.col(c).eqNullSafe(F.col(f"__p{c}")) for c in _RANGE]
    at = F.col("__rank") - F.col("__below")
    hit = wanted.drop("__inside").join(parts, [*same, at >= F.col("__before"), at < F.col("__before") + F.col("__n")])
    return hit.select(*_KEY, "__rank", F.col("__mn").alias("__lo"), F.col("__mx").alias("__hi"),
                      (F.col("__below") + F.col("__before")).alias("__below"), F.col("__n").alias("__inside"))


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """One row a group: ``by`` and an array ``q_<column>`` with the quantile at each of ``probs``.

    Linear interpolation between the two neighbouring ranks, as ``percentile`` has it.  Null values are
    left out; NaN is the largest value.  A column without values in a group has a null array; a group
    (or, without ``by``, a table) without any value has no row.  Null group keys form a group.
    """
    key = F.struct(*[F.col(c) for c in by]) if by else F.struct(F.lit(1).alias("all"))
    joined = ["__g"] if by else []
    values = [F.col(c).cast("double") for c in cols]
    rows = df.select(key.alias("__g"), F.array(*values).alias("__v"))
    facts = F.array(*[F.struct(F.lit(i).alias("__c"), F.count(v).alias("__n"), F.min(v).alias("__lo"), F.max(v).alias("__hi"))
                      for i, v in enumerate(values)])
    whole = df.groupBy(key.alias("__g")).agg(facts.alias("__facts")).select("__g", F.inline("__facts")).where("__n > 0")
    whole = cut_lineage(whole)
    at = [(F.col("__n") - 1) * F.lit(float(p)) for p in probs]
    ranks = F.array_distinct(F.array(*[f(a).cast("long") for a in at for f in (F.floor, F.ceil)]))
    wanted = whole.select(*_KEY, F.explode(ranks).alias("__rank"), "__lo", "__hi", F.lit(0).cast("long").alias("__below"),
                          F.col("__n").alias("__inside"))
    open_ = (F.col("__inside") > SORTED) & (F.col("__lo") < F.col("__hi"))
    while not wanted.where(open_).isEmpty():
        counted = (_in_ranges(rows, wanted.where(open_), joined).groupBy(*_RANGE, _bin(F.col("__v"), F.col("__lo"), F.col("__hi")).alias("__bin"))
                   .agg(F.count(F.lit(1)).alias("__n"), F.min("__v").alias("__mn"), F.max("__v").alias("__mx")))
        wanted = cut_lineage(wanted.where(~open_).unionByName(_narrowed(wanted.where(open_), counted, "__bin")))
    several = F.col("__lo") < F.col("__hi")
    ordered = (_in_ranges(rows, wanted.where(several), joined).groupBy(*_RANGE, "__v").agg(F.count(F.lit(1)).alias("__n"))
              .withColumns({"__mn": F.col("__v"), "__mx": F.col("__v")}))
    found = wanted.where(~several).unionByName(_narrowed(wanted.where(several), ordered, "__v"))
    found = found.groupBy(*_KEY).agg(F.map_from_entries(F.collect_list(F.struct("__rank", "__lo"))).alias("__at"))
    n = whole.select(*_KEY, "__n").withColumnsRenamed({c: f"__w{c}" for c in _KEY})
    found = found.join(n, [F.col(c) == F.col(f"__w{c}") for c in _KEY])
    out = []
    for a in at:
        low, high = F.col("__at")[F.floor(a).cast("long")], F.col("__at")[F.ceil(a).cast("long")]
        out.append(F.when(low == high, low).otherwise((F.ceil(a) - a) * low + (a - F.floor(a)) * high))
    found = found.select("__g", "__c", F.array(*out).alias("__q")).groupBy("__g").agg(
        *[F.max(F.when(F.col("__c") == i, F.col("__q"))).alias(f"q_{c}") for i, c in enumerate(cols)])
    return found.select(*[F.col(f"__g.{c}").alias(c) for c in by], *[f"q_{c}" for c in cols])
