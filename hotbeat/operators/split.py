"""Train/test splits and folds (T1-T3) that are stable under repartitioning.

Membership is a function of a hash of the row key, never of row order or
partition layout, so a re-run after an executor loss gives the same split.
Stratified variants need the exact rank of each row inside its label; with
three labels a window partitioned by label would put the whole table in
three tasks, so the rank is built from hash buckets instead: counts per
(label, bucket) - a few thousand rows - give each bucket's offset, and a
``row_number`` inside (label, bucket) adds the position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _h(key: str, seed: int) -> Column:
    return F.xxhash64(F.col(key), F.lit(seed))


def hash_split(df: DataFrame, key: str, train_fraction: float = 0.8, seed: int = 42,
               out: str = "split") -> DataFrame:
    """``train`` when pmod(hash(key, seed), 10000) < fraction * 10000."""
    cut = int(round(train_fraction * 10000))
    return df.withColumn(out, F.when(F.pmod(_h(key, seed), F.lit(10000)) < cut, "train").otherwise("test"))


def rank_within_label(df: DataFrame, label: str, key: str, seed: int = 42, buckets: int = 1024,
                      out: str = "__rank") -> DataFrame:
    """Exact 0-based rank of each row inside its label, ordered by (hash, key)."""
    h = _h(key, seed)
    d = df.withColumn("__h", h).withColumn("__b", F.pmod(F.col("__h"), F.lit(buckets)))
    counts = d.groupBy(label, "__b").agg(F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy(label).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.withColumn("__off", F.coalesce(F.sum("__n").over(w), F.lit(0)))
    tot = counts.groupBy(label).agg(F.sum("__n").alias("__label_n"))
    # offsets: labels x buckets rows, bounded by configuration -> broadcast
    # null is a label like any other: no row is lost
    offs = offs.select(F.col(label).alias("__l1"), F.col("__b").alias("__b1"), "__off")
    d = d.join(F.broadcast(offs), F.col(label).eqNullSafe(F.col("__l1")) & (F.col("__b") == F.col("__b1")))
    tot = tot.select(F.col(label).alias("__l2"), "__label_n")
    d = d.join(F.broadcast(tot), F.col(label).eqNullSafe(F.col("__l2")))
    local = Window.partitionBy(label, "__b").orderBy("__h", key)
    return (d.withColumn(out, F.row_number().over(local) - 1 + F.col("__off"))
             .drop("__h", "__b", "__off", "__l1", "__b1", "__l2"))


def stratified_split(df: DataFrame, label: str, key: str, train_fraction: float = 0.8, seed: int = 42,
                     out: str = "split") -> DataFrame:
    """Exactly floor(fraction * n_label) rows of every label go to train."""
    r = rank_within_label(df, label, key, seed)
    return (r.withColumn(out, F.when(F.col("__rank") < F.floor(F.col("__label_n") * train_fraction), "train")
                         .otherwise("test"))
             .drop("__rank", "__label_n"))


def stratified_folds(df: DataFrame, label: str, key: str, k: int = 5, seed: int = 42,
                     out: str = "fold") -> DataFrame:
    """fold = rank inside label mod k (label shares equal across folds +-1)."""
    r = rank_within_label(df, label, key, seed)
    return r.withColumn(out, (F.col("__rank") % k).cast("int")).drop("__rank", "__label_n")


def random_split(df: DataFrame, weights=(0.8, 0.2), seed: int = 42):
    """Spark's own ``randomSplit`` (order-dependent; kept as an option)."""
    return df.randomSplit(list(weights), seed)
