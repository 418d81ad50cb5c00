"""Code-to-label functions (C1-C4) and the literal lookup tables.

The two Python UDFs of the source workflow (shift number, code category)
become a CASE expression and a broadcast join; both stay JVM-side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hotbeat import fixed
from hotbeat.session import broadcast_if_small


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def descent_label(c) -> Column:
    """One-letter descent code -> label; unknown or null -> ``Unknown``."""
    pairs = []
    for code, label in fixed.descent_codes():
        pairs += [F.lit(code), F.lit(label)]
    return F.coalesce(F.create_map(*pairs)[_c(c)], F.lit("Unknown"))


def age_group(c) -> Column:
    """Age band.  <1 Infant, bands from the fixed table, >65 Senior."""
    a = _c(c)
    e = F.when(a < 1, F.lit("Infant"))
    for label, lo, hi in fixed.age_bands():
        e = e.when((a >= lo) & (a <= hi), F.lit(label))
    last_hi = fixed.age_bands()[-1][2]
    return e.when(a > last_hi, F.lit("Senior")).otherwise(F.lit("Unknown"))


CATEGORY_SCHEMA = T.StructType([T.StructField("crm_cd", T.IntegerType(), False),
                                T.StructField("crime_category", T.StringType(), False)])


def category_df(spark: SparkSession) -> DataFrame:
    """S3: the 139-row code dictionary as a DataFrame (labels trimmed, Q12)."""
    return spark.createDataFrame(fixed.category_codes(), CATEGORY_SCHEMA)


#: Rows up to which a caller's lookup is broadcast.
MAX_LOOKUP_ROWS = 100_000


def _lookup(df: DataFrame, lookup: DataFrame | None, out: str) -> DataFrame:
    """(__code, out) of the dictionary or the caller's table, hinted by its size."""
    cat = lookup if lookup is not None else category_df(df.sparkSession)
    cat = cat.select(F.col(cat.columns[0]).alias("__code"), F.col(cat.columns[1]).alias(out))
    return broadcast_if_small(cat, MAX_LOOKUP_ROWS, None if lookup is not None else len(fixed.category_codes()))[0]


def category_of(df: DataFrame, code_col: str = "crm_cd",
                out: str = "crime_category", lookup: DataFrame | None = None,
                default: str = "Unknown") -> DataFrame:
    """Left lookup with default.

    The dictionary has a fixed size (139 rows) and is broadcast; a caller's
    lookup is broadcast only if it is small, else joined by a shuffle.
    """
    cat = _lookup(df, lookup, "__cat")
    j = df.join(cat, F.col(code_col) == F.col("__code"), "left")
    return j.withColumn(out, F.coalesce(F.col("__cat"), F.lit(default))).drop("__code", "__cat")


def category_inner(df: DataFrame, code_col: str = "crm_cd",
                   out: str = "crime_category", lookup: DataFrame | None = None) -> DataFrame:
    """Inner equi-join to the dictionary (rows with unmapped codes drop)."""
    return df.join(_lookup(df, lookup, out), F.col(code_col) == F.col("__code"), "inner").drop("__code")


def crime_type(c) -> Column:
    """C4: ``Violent`` for the ten violent categories, else ``Property``."""
    return F.when(_c(c).isin(fixed.VIOLENT_CATEGORIES), F.lit("Violent")).otherwise(F.lit("Property"))


def category_values_sql() -> str:
    """The dictionary as a SQL ``VALUES`` list (for the DuckDB oracle)."""
    rows = ", ".join(f"({c}, '{lab}')" for c, lab in fixed.category_codes())
    return f"(VALUES {rows}) AS cat(crm_cd, crime_category)"
