"""Feature preparation (F1-F6) with Spark ML stages.

Fitting a ``StringIndexer`` collects the distinct labels of a categorical
column (bounded by its cardinality) - never fact rows.  Scaling statistics
are one aggregate row.  PCA works on the d x d covariance built by a
distributed tree aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, PCA, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hotbeat.operators.attach import attach


#: Columns that one categorical column may become.
MAX_LEVELS = 1000


def one_hot_pipeline(cats: Sequence[str], nums: Sequence[str] = (), out: str = "features",
                     order: str = "frequencyDesc", drop_last: bool = True) -> Pipeline:
    """F1 / F2: index + one-hot every categorical column, assemble with numerics.

    ``handleInvalid='keep'`` gives null / unseen labels their own slot
    instead of failing the job.
    """
    idx = [f"{c}_index" for c in cats]
    ohe = [f"{c}_ohe" for c in cats]
    stages = []
    if cats:
        stages += [StringIndexer(inputCols=list(cats), outputCols=idx, handleInvalid="keep",
                                 stringOrderType=order),
                   OneHotEncoder(inputCols=idx, outputCols=ohe, dropLast=drop_last, handleInvalid="keep")]
    stages.append(VectorAssembler(inputCols=ohe + list(nums), outputCol=out, handleInvalid="keep"))
    return Pipeline(stages=stages)


def one_hot(df: DataFrame, cats: Sequence[str], nums: Sequence[str] = (), out: str = "features") -> DataFrame:
    return one_hot_pipeline(cats, nums, out).fit(df).transform(df)


def dummies(df: DataFrame, col: str, levels: Sequence | None = None, drop_first: bool = True,
            prefix: str | None = None) -> DataFrame:
    """0/1 indicator columns, alphabetically first level dropped.

    ``levels`` may be passed; otherwise the distinct values are read once.
    More than ``MAX_LEVELS`` of them are not a category: that is an error.
    """
    if levels is None:
        levels = [r[0] for r in df.select(col).filter(F.col(col).isNotNull()).distinct().limit(MAX_LEVELS + 1).collect()]
        if len(levels) > MAX_LEVELS:
            raise ValueError(f"{col} has more than {MAX_LEVELS} values")
    levels = sorted(levels)
    keep = levels[1:] if drop_first else levels
    p = prefix or col
    return df.select("*", *[F.when(F.col(col) == F.lit(v), 1).otherwise(0).alias(f"{p}_{v}") for v in keep])


def label_encode(df: DataFrame, col: str, out: str | None = None):
    """alphabetical 0..n-1 codes; returns (frame, fitted indexer model)."""
    m = StringIndexer(inputCol=col, outputCol=out or f"{col}_index", stringOrderType="alphabetAsc",
                      handleInvalid="keep").fit(df)
    return m.transform(df), m


def standardise(df: DataFrame, cols: Sequence[str], by=None, suffix: str = "_z") -> DataFrame:
    """(x - mean) / population sd per column (optionally per group).

    The statistics are one row (per group).  A column without spread becomes 0.
    """
    g = [by] if isinstance(by, str) else list(by or [])
    st = df.groupBy(*g).agg(*[F.avg(c).alias(f"__m_{c}") for c in cols],
                            *[F.stddev_pop(c).alias(f"__s_{c}") for c in cols])
    out = attach(df, st, g)
    for c in cols:
        out = out.withColumn(f"{c}{suffix}", F.when(F.col(f"__s_{c}") == 0, F.col(c) - F.col(f"__m_{c}"))
                             .otherwise((F.col(c) - F.col(f"__m_{c}")) / F.nullif(F.col(f"__s_{c}"), F.lit(0.0))))
    return out.drop(*[x for x in st.columns if x.startswith("__")])


def pca_report(df: DataFrame, cols: Sequence[str] | None = None, vector_col: str | None = None,
               target: float = 0.9, standardize: bool = True):
    """F6 (+ W5): explained variance per component with running total, and
    feature contribution = sum of |loading| over the components needed to
    reach ``target`` - returned as two small DataFrames (d rows each)."""
    spark = df.sparkSession
    if vector_col is None:
        d = df.select(*cols)
        if standardize:
            d = standardise(d, cols, suffix="_z").select(*[F.col(f"{c}_z").alias(c) for c in cols])
        d = VectorAssembler(inputCols=list(cols), outputCol="__v", handleInvalid="skip").transform(d)
        names = list(cols)
    else:
        d = df.select(F.col(vector_col).alias("__v"))
        first = d.first()
        names = [f"f{i}" for i in range(len(first[0]))]
    k = len(names)
    model = PCA(k=k, inputCol="__v", outputCol="__pc").fit(d)
    ev = [float(x) for x in model.explainedVariance.toArray()]
    var = spark.createDataFrame([(i + 1, v) for i, v in enumerate(ev)], "component int, explained_variance double")
    var = var.withColumn("cumulative", F.sum("explained_variance").over(
        Window.orderBy("component").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    need, run = 0, 0.0
    for v in ev:
        need += 1
        run += v
        if run >= target:
            break
    pc = model.pc.toArray()
    contrib = [(names[i], float(sum(abs(pc[i, j]) for j in range(need)))) for i in range(k)]
    ranking = spark.createDataFrame(contrib, "feature string, contribution double")
    ranking = ranking.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("contribution"), "feature")))
    return var, ranking, need


def embedding_vectors(emb: DataFrame, col: str = "embedding", out: str = "features") -> DataFrame:
    return emb.withColumn(out, array_to_vector(F.col(col).cast("array<double>")))


def vector_columns(df: DataFrame, col: str, names: Sequence[str]) -> DataFrame:
    arr = vector_to_array(F.col(col))
    return df.select("*", *[arr[i].alias(n) for i, n in enumerate(names)])
