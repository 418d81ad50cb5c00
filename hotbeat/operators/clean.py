"""Cleaning operators P1-P17: DataFrame in, DataFrame out.

Profiles (P1, P3, P4) are single aggregations: one job, partial aggregation
map-side, a one-row result.  Nothing loops over columns with actions.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def duplicate_count(df: DataFrame) -> DataFrame:
    """Number of surplus copies of exact duplicate rows (one job).

    ``groupBy(all columns)`` pre-aggregates map-side, so a row repeated a
    billion times collapses before the shuffle.
    """
    g = df.groupBy(*df.columns).count()
    return g.agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("long").alias("duplicates"),
                 F.count(F.lit(1)).alias("distinct_rows"))


def dedupe(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Keep one of each duplicate (really applied, Q1)."""
    return df.dropDuplicates(subset) if subset else df.dropDuplicates()


def null_profile(df: DataFrame) -> DataFrame:
    """One row, one null count per column."""
    return df.select([F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def null_ratio(df: DataFrame) -> DataFrame:
    """(column_name, null_count, null_ratio) sorted by ratio, descending.

    One aggregation computes every count; ``stack`` turns the single row
    into one row per column.
    """
    aggs = [F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)]
    one = df.agg(F.count(F.lit(1)).alias("__rows"), *aggs)
    pairs = ", ".join(f"'{c}', n{i}" for i, c in enumerate(df.columns))
    long = one.selectExpr("__rows", f"stack({len(df.columns)}, {pairs}) AS (column_name, null_count)")
    return (long.select("column_name", "null_count",
                        F.round(F.col("null_count") / F.col("__rows"), 6).alias("null_ratio"))
            .orderBy(F.desc("null_ratio"), "column_name"))


def zero_to_null(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """P5."""
    for c in cols:
        df = df.withColumn(c, F.nullif(F.col(c), F.lit(0)))
    return df


def drop_any_null(df: DataFrame) -> DataFrame:
    """P6."""
    return df.na.drop(how="any")


def drop_null(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """P7 (really applied, Q2)."""
    return df.na.drop(subset=list(cols))


def clean_age(df: DataFrame, col: str = "vict_age", minimum: int = 1) -> DataFrame:
    """Ages below ``minimum`` mean unknown -> null."""
    return df.withColumn(col, F.when(F.col(col) >= minimum, F.col(col)))


def fill_defaults(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """P9."""
    return df.fillna(dict(values))


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def fill_text(df: DataFrame, value: str = "N/A") -> DataFrame:
    """P10: every text column's nulls -> ``value`` (from the schema; no count jobs)."""
    cols = string_columns(df)
    return df.fillna(value, subset=cols) if cols else df


def normalise_codes(df: DataFrame, col: str, mapping: Mapping[str, str]) -> DataFrame:
    """Merge odd codes, e.g. ``H``/``-`` -> ``X``."""
    return df.replace(dict(mapping), subset=[col])


def valid_location(df: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Drop (0, 0) placeholders; null coordinates drop too (Q5)."""
    return df.filter((F.col(lat) != 0.0) & (F.col(lon) != 0.0))


def drop_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """P13."""
    return df.drop(*cols)


def select_features(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return df.select(*cols)


def filter_eq(df: DataFrame, col: str, value, negate: bool = False) -> DataFrame:
    """Equality / exclusion filter (pushed to the scan when possible)."""
    cond = F.col(col) == F.lit(value)
    return df.filter(~cond if negate else cond)


def filter_in(df: DataFrame, col: str, values: Iterable) -> DataFrame:
    """P15."""
    return df.filter(F.col(col).isin(list(values)))


def exclude_noise(df: DataFrame, col: str = "cluster", noise: int = -1) -> DataFrame:
    """P16 (``!= -1``, Q13)."""
    return df.filter(F.col(col) != noise)


def coerce_double(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Lenient numeric coercion (junk -> null)."""
    for c in cols:
        df = df.withColumn(c, F.col(c).try_cast("double"))
    return df


def to_text(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, F.col(c).cast("string"))
    return df


def any_null(cols: Iterable[str]) -> Column:
    e = F.lit(False)
    for c in cols:
        e = e | F.col(c).isNull()
    return e
