"""Descriptive aggregates (A*), window operators (W*), ordering (O*), sets (U*).

Every aggregate is a ``groupBy``: partial aggregation map-side, one shuffle
of partial rows on the keys.  Windows only ever run over already-aggregated
rows whose count is bounded by the key cardinality (categories, months,
clusters), never over fact rows, except where partitioned by a key whose
groups are bounded by construction (a series of one cluster).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hotbeat.operators.attach import attach
from hotbeat.operators.quantiles import exact_quantiles


def _cols(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def counts_by(df: DataFrame, keys, name: str = "n") -> DataFrame:
    """Rows per key."""
    return df.groupBy(*_cols(keys)).agg(F.count(F.lit(1)).alias(name))


def max_count(counts: DataFrame, col: str = "n", name: str = "max_n") -> DataFrame:
    """A2: aggregate of an aggregate (busiest key's count)."""
    return counts.agg(F.max(col).alias(name))


def share_by(df: DataFrame, keys, within: Sequence[str] = (), name: str = "n",
             share: str = "share", digits: int = 6) -> DataFrame:
    """Count per key and its share of the total (within a partition).

    The window runs over the aggregated counts (one row per key), not rows.
    """
    c = counts_by(df, keys, name)
    w = Window.partitionBy(*within) if within else Window.partitionBy()
    return c.withColumn(share, F.round(F.col(name) / F.sum(name).over(w), digits))


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """O2: order then limit -> ``TakeOrderedAndProject`` (per-task top-n, then merge)."""
    return df.orderBy(*order).limit(n)


def weekday_counts(df: DataFrame, date: str = "occ_date") -> DataFrame:
    """A4: rows per weekday in Monday-first order."""
    return (df.groupBy(F.weekday(date).alias("weekday_index"),
                       F.date_format(date, "EEEE").alias("weekday_name"))
              .agg(F.count(F.lit(1)).alias("n"))
              .orderBy("weekday_index"))


def exact_mean_expr(col: str, digits: int = 6, int_div: str = "div") -> str:
    """Mean rounded half-up to ``digits``, independent of summation order.

    Values are scaled to integers (``round(x * 10^d)``), summed exactly in a
    38-digit integer type (no overflow even for 10^15 rows of coordinates),
    and the rounded quotient is formed by integer division, so every engine
    and every partitioning gives the same double.  ``int_div`` selects the
    dialect: ``div`` (Spark, DECIMAL(38,0)) or ``//`` (DuckDB, HUGEINT).
    """
    f = 10 ** digits
    wide = "DECIMAL(38,0)" if int_div == "div" else "HUGEINT"
    s = f"sum(CAST(round({col} * {f}) AS {wide}))"
    n = f"count({col})"
    return f"sign({s}) * ((abs({s}) * 2 + {n}) {int_div} ({n} * 2)) / {float(f)!r}"


def group_means(df: DataFrame, by, cols: Iterable[str], digits: int = 6) -> DataFrame:
    """Feature means per group, rounded half-up to ``digits``.

    Uses ``exact_mean_expr`` so the result does not depend on the order in
    which partial sums are merged.
    """
    return df.groupBy(*_cols(by)).agg(
        *[F.expr(exact_mean_expr(c, digits)).alias(f"avg_{c}") for c in cols])


def summary_stats(df: DataFrame, col: str, digits: int = 6) -> DataFrame:
    """Count, mean, sample sd, min, exact quartiles (linear interpolation, by selection), max."""
    c = F.col(col)
    one = df.agg(F.count(c).alias("count"),
                 F.round(F.avg(c), digits).alias("mean"),
                 F.round(F.stddev_samp(c), digits).alias("std"),
                 F.min(c).cast("double").alias("min"),
                 F.max(c).cast("double").alias("max"))
    one = attach(one, exact_quantiles(df, [col], [0.25, 0.5, 0.75]).withColumnRenamed(f"q_{col}", "__q"), [])
    quartiles = [F.round(F.col("__q")[i], digits).alias(f"q{q}") for i, q in enumerate((25, 50, 75))]
    return one.select("count", "mean", "std", "min", *quartiles, "max")


def sums_by(df: DataFrame, by, cols: Iterable[str], scale: int = 2) -> DataFrame:
    """Numeric sums per key.

    Summed as DECIMAL(38, scale) - exact and independent of partitioning -
    then returned as DOUBLE.  ``scale`` is the number of decimals the
    source values carry (2 for money).
    """
    return df.groupBy(*_cols(by)).agg(
        *[F.sum(F.col(c).cast(f"decimal(38,{scale})")).cast("double").alias(f"sum_{c}") for c in cols])


def distinct_sorted(df: DataFrame, cols) -> DataFrame:
    """A18 / U2."""
    cols = _cols(cols)
    return df.select(*cols).distinct().orderBy(*cols)


def row_multiplicity(df: DataFrame, name: str = "n") -> DataFrame:
    """How often each whole row occurs, most frequent first."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(name)).orderBy(F.desc(name))


def code_dictionary(df: DataFrame, code: str, desc: str) -> DataFrame:
    """One description per code, deterministic (max)."""
    return df.groupBy(code).agg(F.max(desc).alias(desc)).orderBy(code)


def corr_matrix(df: DataFrame, cols: Sequence[str], digits: int = 6) -> DataFrame:
    """Pearson lower triangle (a, b, corr) from ONE aggregation.

    ``F.corr`` drops rows where either side is null (pairwise complete),
    unlike ``df.stat.corr`` (Q24).
    """
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[:i]]
    one = df.agg(*[F.corr(a, b).alias(f"c{k}") for k, (a, b) in enumerate(pairs)])
    body = ", ".join(f"'{a}', '{b}', c{k}" for k, (a, b) in enumerate(pairs))
    long = one.selectExpr(f"stack({len(pairs)}, {body}) AS (col_a, col_b, corr)")
    return long.withColumn("corr", F.round("corr", digits))


def pivot_counts(df: DataFrame, row: str, col: str, values: Sequence) -> DataFrame:
    """``row`` x ``col`` counts with 0 for empty cells.

    ``values`` is passed so Spark skips the distinct-values job and the
    output schema is fixed.
    """
    return df.groupBy(row).pivot(col, list(values)).count().fillna(0)


def top1_per_group(counts: DataFrame, group, key: str, n: str = "n") -> DataFrame:
    """Most common ``key`` per group; ties to the smallest key.

    Input is an aggregate (group x key), so each window partition holds at
    most (distinct keys) rows.
    """
    w = Window.partitionBy(*_cols(group)).orderBy(F.desc(n), F.asc(key))
    return counts.withColumn("__r", F.row_number().over(w)).filter("__r = 1").drop("__r")


def top_bottom_per_group(counts: DataFrame, group, key: str, n_top: int, n: str = "n") -> DataFrame:
    """Top-n and bottom-n keys per group in one window pass."""
    g = _cols(group)
    wt = Window.partitionBy(*g).orderBy(F.desc(n), F.asc(key))
    wb = Window.partitionBy(*g).orderBy(F.asc(n), F.asc(key))
    r = counts.withColumn("top_rank", F.row_number().over(wt)).withColumn("bottom_rank", F.row_number().over(wb))
    return r.filter((F.col("top_rank") <= n_top) | (F.col("bottom_rank") <= n_top))


def first_difference(series: DataFrame, key, period: str, value: str, out: str = "diff") -> DataFrame:
    """X - lag(x) per key in period order (series rows are bounded by time)."""
    w = Window.partitionBy(*_cols(key)).orderBy(period)
    return series.withColumn(out, F.col(value) - F.lag(value).over(w))


def rank_by_count(counts: DataFrame, n: str = "n", key: str | None = None, out: str = "rank") -> DataFrame:
    """O3: rank of each key by volume (over the aggregate, one row per key)."""
    order = [F.desc(n)] + ([F.asc(key)] if key else [])
    return counts.withColumn(out, F.rank().over(Window.orderBy(*order)))


def keep_top_groups(df: DataFrame, group: str, n_groups: int) -> DataFrame:
    """Rows of the ``n_groups`` largest groups.

    The list of groups is bounded by ``n_groups`` so it is broadcast into a
    left-semi join; the fact side is never shuffled.
    """
    top = (counts_by(df, group).orderBy(F.desc("n"), F.asc(group)).limit(n_groups).select(group))
    return df.join(F.broadcast(top), group, "left_semi")


def append(frames: Sequence[DataFrame]) -> DataFrame:
    """True append by column name."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def cumulative(df: DataFrame, order: str, value: str, out: str = "cumulative") -> DataFrame:
    """Running sum over a small ordered table (k rows, e.g. variances)."""
    w = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(out, F.sum(value).over(w))
