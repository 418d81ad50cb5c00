"""Shift classification: logistic models, class report and baseline.

One logistic model is trained by Spark ML (tree aggregation of gradients), one a key by Newton steps over
sums by key; trees and their searches
(L2-L6, L8) are in ``trees``.  The class report is a ``groupBy(label, prediction)`` confusion table
with the ratios in SQL.
"""

from __future__ import annotations

import operator
import warnings
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hotbeat.operators.kmeans import Kept
from hotbeat.session import cut_lineage

LABEL = "label"


def with_label(df: DataFrame, target: str = "time_slot") -> DataFrame:
    """Spark ML wants 0-based double labels: shift 1..3 -> 0..2."""
    return df.withColumn(LABEL, (F.col(target) - 1).cast("double"))


def assembler(features: Sequence[str], out: str = "raw") -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="skip")


def training_rows(df: DataFrame) -> DataFrame:
    """Rows of the training split whose label is known."""
    return df.filter((F.col("split") == "train") & F.col(LABEL).isNotNull())


def predict(model, df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Predictions for every row: null where a feature is missing."""
    scored = model.transform(df.na.drop(subset=list(features))).select(*df.columns, "prediction")
    missing = df.filter(" OR ".join(f"{c} IS NULL" for c in features)).withColumn("prediction", F.lit(None).cast("double"))
    return scored.unionByName(missing)


def logistic_pipeline(features: Sequence[str], max_iter: int = 200) -> Pipeline:
    """L1: standardise (F5) + multinomial logistic regression."""
    return Pipeline(stages=[assembler(features),
                            StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True),
                            LogisticRegression(featuresCol="features", labelCol=LABEL, family="multinomial",
                                               maxIter=max_iter)])


def balanced_weights(df: DataFrame, label: str = LABEL, out: str = "class_weight") -> DataFrame:
    """Balanced class weight n / (classes * n_class), via one small aggregate."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("__nc"))
    everything = Window.partitionBy()
    # one row per class: the window and the broadcast are bounded by the class count
    stats = (counts.withColumn("__n", F.sum("__nc").over(everything))
                   .withColumn("__k", F.count(F.lit(1)).over(everything)))
    return (df.join(F.broadcast(stats), label)
              .withColumn(out, F.col("__n") / (F.col("__k") * F.col("__nc")))
              .drop("__nc", "__n", "__k"))


def class_report(pred: DataFrame, label: str = LABEL, prediction: str = "prediction") -> DataFrame:
    """Per class precision, recall, F1, support, plus overall accuracy.

    One ``groupBy(label, prediction)`` pass builds the confusion counts
    (classes^2 rows); everything after works on that tiny table.
    """
    cm = pred.groupBy(F.col(label).alias("y"), F.col(prediction).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    tp = cm.filter(F.col("y") == F.col("p")).select(F.col("y").alias("cls"), F.col("n").alias("tp"))
    sup = cm.groupBy(F.col("y").alias("cls")).agg(F.sum("n").alias("support"))
    pp = cm.groupBy(F.col("p").alias("cls")).agg(F.sum("n").alias("predicted"))
    r = (sup.join(pp, "cls", "full").join(tp, "cls", "left").fillna(0, ["tp", "support", "predicted"]))
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(F.lit(0.0))
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0))
    r = r.withColumn("precision", prec).withColumn("recall", rec)
    r = r.withColumn("f1", F.when(F.col("precision") + F.col("recall") > 0,
                                  2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall")))
                     .otherwise(F.lit(0.0)))
    w = Window.partitionBy()
    r = r.withColumn("accuracy", F.sum("tp").over(w) / F.sum("support").over(w))
    return r.select("cls", F.round("precision", 6).alias("precision"), F.round("recall", 6).alias("recall"),
                    F.round("f1", 6).alias("f1"), F.col("support").cast("long").alias("support"),
                    F.round("accuracy", 6).alias("accuracy"))


def _softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def keyed_logistic(df: DataFrame, features: Sequence[str], by: str, label: str = LABEL, classes: int = 3, ridge: float = 1.0,
                   max_iter: int = 30, tol: float = 1e-8) -> DataFrame:
    """One multinomial logistic model for every value of ``by``, all fitted side by side.

    -> (by, mean, sd, w): standardisation and weights, class by class, the intercept last.  Minimises the
    log loss plus ``ridge`` / 2 times the squared weights (not intercepts) by Newton steps.  A step is one
    job for all keys: tasks add gradients and curvatures by key, the few sums of a key are solved together.
    Keys whose weights stay are left out of later steps; a warning tells if some still move at the end.
    Rows with a null feature or a label that is no class take no part; a null key is a key like any.
    """
    d, wide = len(features), len(features) + 1
    size = classes * wide
    rows = df.where(F.col(label).between(0, classes - 1)).na.drop(subset=list(features))
    st = rows.groupBy(by).agg(*[f(c).alias(f"{n}{i}") for i, c in enumerate(features) for f, n in ((F.avg, "m"), (F.stddev_pop, "s"))])
    st = cut_lineage(st.select(F.col(by).alias("__k"), F.array(*[f"m{i}" for i in range(d)]).alias("mean"),
                               F.array(*[F.when(F.col(f"s{i}") > 0, F.col(f"s{i}")).otherwise(1.0) for i in range(d)]).alias("sd")))
    z = F.zip_with(F.zip_with("x", "mean", lambda x, m: x - m), "sd", lambda x, s: x / s)
    rows = rows.select(F.col(by).alias("__b"), F.array(*[F.col(c).cast("double") for c in features]).alias("x"), F.col(label).cast("int").alias("y"))
    rows = cut_lineage(rows.join(st, F.col("__b").eqNullSafe(F.col("__k"))).select("__b", z.alias("z"), "y"))
    kind = df.schema[by].dataType.simpleString()

    def add_up(batches):
        """(key, w, sums): gradient and curvature of the rows of a batch by key."""
        for b in batches:
            if not b.num_rows:
                continue
            x = np.column_stack([b.column("z").flatten().to_numpy().reshape(-1, d), np.ones(b.num_rows)])
            w = b.column("w").flatten().to_numpy().reshape(-1, size)
            y = np.eye(classes)[b.column("y").to_numpy()]
            codes = b.column("__b").dictionary_encode("encode")
            at, out = codes.indices.to_numpy(), []
            for k in np.unique(at).tolist():
                own = at == k
                xs, ws = x[own], w[own][0].reshape(classes, wide)
                p = _softmax(xs @ ws.T)
                g = ((p - y[own]).T @ xs).ravel()
                h = np.zeros((classes, wide, classes, wide))
                for i in range(classes):
                    for j in range(classes):
                        h[i, :, j, :] = (xs * (p[:, i] * ((i == j) - p[:, j]))[:, None]).T @ xs
                out.append((np.flatnonzero(own)[0], ws.ravel(), np.concatenate([g, h.ravel()])))
            yield pa.RecordBatch.from_arrays([b.column("__b").take(pa.array([o[0] for o in out])), pa.array([o[1] for o in out], pa.list_(pa.float64())),
                                              pa.array([o[2] for o in out], pa.list_(pa.float64()))], names=["__b", "w", "sums"])

    def solve(t: pa.Table) -> pa.Table:
        w = t.column("w")[0].values.to_numpy()
        sums = np.sum([v.values.to_numpy() for v in t.column("sums")], 0)
        penalty = np.tile(np.r_[np.full(d, ridge), 0.0], classes)
        g, h = sums[:size] + penalty * w, sums[size:].reshape(size, size) + np.diag(penalty)
        step = np.linalg.lstsq(h, g, rcond=1e-12)[0]  # intercepts are free up to a common shift
        step *= min(1.0, 5.0 / max(np.abs(step).max(), 1e-300))
        moving = bool(np.abs(step).max() > tol and np.abs(g).max() > 1e-7)
        return pa.table([t.column("__b").slice(0, 1), pa.array([w - step], pa.list_(pa.float64())), pa.array([moving])], names=["__b", "w", "active"])

    state = Kept(df.sparkSession, "logistic")
    schema = f"__b {kind}, w array<double>, active boolean"
    state.put(st.select(F.col("__k").alias("__b"), F.array_repeat(F.lit(0.0), size).alias("w"), F.lit(True).alias("active")))
    for _ in range(max_iter):
        now = state.df.where("active").select(F.col("__b").alias("__a"), "w")
        sums = rows.join(now, F.col("__b").eqNullSafe(F.col("__a"))).drop("__a").mapInArrow(add_up, f"__b {kind}, w array<double>, sums array<double>")
        if state.put(sums.groupBy("__b").applyInArrow(solve, schema).unionByName(state.df.where("NOT active")), F.col("active")) == 0:
            break
    else:
        warnings.warn(f"logistic weights still moving after {max_iter} steps", RuntimeWarning, stacklevel=2)
    return state.df.join(st, F.col("__b").eqNullSafe(F.col("__k"))).select(F.col("__b").alias(by), "mean", "sd", "w")


def predict_keyed(df: DataFrame, models: DataFrame, features: Sequence[str], by: str, classes: int = 3) -> DataFrame:
    """``df`` with the likeliest class by its key's model; null without a model or with a null feature."""
    wide = len(features) + 1
    m = models.select(F.col(by).alias("__k"), *[F.col(c).alias(f"__{c}") for c in ("mean", "sd", "w")])

    def score(k: int):
        weight = lambda i: F.col("__w")[k * wide + i]
        terms = [weight(i) * (F.col(c) - F.col("__mean")[i]) / F.col("__sd")[i] for i, c in enumerate(features)]
        return F.struct(sum(terms, weight(wide - 1)).alias("s"), F.lit(-k).alias("k"))

    best = F.array_max(F.array(*[score(k) for k in range(classes)]))
    known = reduce(operator.and_, [F.col(c).isNotNull() for c in features]) & F.col("__w").isNotNull()
    return (df.join(m, df[by].eqNullSafe(F.col("__k")), "left")
            .withColumn("prediction", F.when(known, (-best["k"]).cast("double"))).drop("__k", "__mean", "__sd", "__w"))


def baseline_shift(df: DataFrame, keys: Sequence[str] = ("area", "occ_weekday"), target: str = "time_slot",
                   out: str = "predicted_slot") -> DataFrame:
    """Most frequent shift per key (ties to the earlier shift).

    The window runs over (key x shift) counts - at most 3 rows per key.
    """
    c = df.filter(F.col(target).isNotNull()).groupBy(*keys, target).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*keys).orderBy(F.desc("n"), F.asc(target))
    return (c.withColumn("__r", F.row_number().over(w)).filter("__r = 1")
             .select(*keys, F.col(target).alias(out), F.col("n").alias("support")))


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path
