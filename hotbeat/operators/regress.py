"""Least squares for many groups at once from sums of products.

Every row carries a vector [regressors..., target].  One aggregate per group
adds the products of its entries (partial sums before the shuffle); what is
left is one small symmetric system a group, solved by sweeping its columns.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A column whose part not explained by the earlier ones is below this share of it counts as dependent.
DEPENDENT = 1e-10


def product_sums(df: DataFrame, by: list[str], vector: str) -> DataFrame:
    """One row a group: ``by``, ``rows`` and ``sums``, the upper triangle of v v' added over its vectors, row by row.

    Vectors of one group have one length.  Null group keys form a group.
    """
    key = F.struct(*by).alias("__g")
    products = F.expr(f"flatten(transform({vector}, (a, i) -> transform(slice({vector}, i + 1, size({vector}) - i), b -> a * b)))")
    one = df.select(key, F.posexplode(products).alias("__at", "__product")).groupBy("__g", "__at")
    one = one.agg(F.sum("__product").alias("__sum"), F.count(F.lit(1)).alias("__rows"))
    whole = one.groupBy("__g").agg(F.max("__rows").alias("rows"), F.sort_array(F.collect_list(F.struct("__at", "__sum"))).alias("__all"))
    return whole.select("__g.*", "rows", F.transform("__all", lambda s: s["__sum"]).alias("sums"))


def square(sums: np.ndarray) -> np.ndarray:
    """The symmetric matrix of an upper triangle given row by row."""
    n = int((np.sqrt(8 * len(sums) + 1) - 1) / 2)
    out = np.zeros((n, n))
    out[np.triu_indices(n)] = sums
    return out + np.triu(out, 1).T


def sweeps(products: np.ndarray) -> Iterator[tuple[np.ndarray, float, np.ndarray, int]]:
    """After each regressor: coefficients so far, squared residuals, inverse of the products, columns in use.

    A regressor that depends on earlier ones is passed over and has coefficient 0.
    """
    scale = np.sqrt(np.diag(products))
    scale[scale == 0] = 1.0
    a = products / np.outer(scale, scale)
    used: list[int] = []
    for k in range(len(a) - 1):
        if a[k, k] > DEPENDENT:
            pivot, row = a[k, k], a[k].copy()
            column = a[:, k].copy()
            a = a - np.outer(column, row) / pivot
            a[k], a[:, k] = row / pivot, -column / pivot
            a[k, k] = 1.0 / pivot
            used.append(k)
        beta = np.zeros(k + 1)
        beta[used] = a[used, -1] * scale[-1] / scale[used]
        inverse = np.zeros((k + 1, k + 1))
        inverse[np.ix_(used, used)] = a[np.ix_(used, used)] / np.outer(scale[used], scale[used])
        yield beta, max(float(a[-1, -1]) * scale[-1] ** 2, 0.0), inverse, len(used)


def least_squares(sums: Column) -> Column:
    """Coefficients of the last entry on all others, by group; null without sums."""
    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def solve(column: pd.Series) -> pd.Series:
        return column.map(lambda s: None if s is None else list(sweeps(square(s)))[-1][0])
    return solve(sums)
