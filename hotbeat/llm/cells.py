"""Grid of (query block, candidate block) cells for searches of a stated query set against all rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hotbeat.llm.common import written

#: Most candidates and queries of a cell on average: bounds what one task holds.
CANDIDATES_PER_CELL = 65_536
QUERIES_PER_CELL = 16_384


def finite_vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(row, id, v) of the rows whose vector has components, none of them null or not finite.

    ``row`` tells repeated ids apart; other columns of ``df`` are dropped, whatever their names.
    """
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return (df.select(F.col(id_col).alias("id"), F.col(vec_col).alias("v"))
            .withColumn("row", F.monotonically_increasing_id())
            .where(F.col("id").isNotNull() & (F.size("v") > 0) & ~F.exists("v", bad)))


def search_cells(rows: DataFrame, is_query: Column, per_cell, k: int) -> DataFrame:
    """The best ``k`` candidates of each query: (query_id, rank, vec_id, score).

    Candidates are dealt at random into S groups and queries into U; every cell (s, u) of the grid is
    one task of bounded size that returns its best k of each of its queries, and these short lists are
    merged.  Each candidate travels U times and each query S times; no pair does.  The rows are written once
    to the shared folder, so that a row has the same number on both sides even if the input is computed anew.
    ``per_cell(candidates, queries, k)`` gets (row, id, matrix) twice and returns arrays
    (query row, query id, candidate id, score).
    """
    rows = written(rows, "search-rows")
    n, q = rows.select(F.count("*"), F.count(F.when(is_query, 1))).first()
    spread = rows.sparkSession.sparkContext.defaultParallelism
    s_groups = max(1, -(-n // CANDIDATES_PER_CELL), min(spread, n // 2048))
    u_groups = max(1, -(-q // QUERIES_PER_CELL))
    deal = lambda groups: F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int")
    every = lambda groups: F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    candidates = rows.withColumn("s", deal(s_groups)).withColumn("u", every(u_groups)).withColumn("d", F.size("v"))
    queries = rows.where(is_query).withColumn("u", deal(u_groups)).withColumn("s", every(s_groups)).withColumn("d", F.size("v"))
    queries = queries.select(*[F.col(c).alias(c) for c in queries.columns])  # columns of its own beside the candidates'
    kind = rows.schema["id"].dataType.simpleString()
    score = "long" if per_cell.__name__ == "exact_cell" else "double"

    def unpack(t: pa.Table):
        t = t.combine_chunks()
        d = t.column("d")[0].as_py()
        v = t.column("v").combine_chunks()
        flat = (v.chunk(0) if isinstance(v, pa.ChunkedArray) else v).flatten().to_numpy(zero_copy_only=False)
        return t.column("row").to_numpy(), t.column("id").to_numpy(), flat.reshape(-1, d)

    def run(have: pa.Table, want: pa.Table) -> pa.Table:
        if have.num_rows and want.num_rows:
            found = per_cell(unpack(have), unpack(want), k)
        else:
            found = [np.zeros(0, np.int64)] * 4
        return pa.table([pa.array(np.asarray(a), t) for a, t in zip(found, types)], names=["q_row", "q", "c", "score"])

    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64() if score == "long" else pa.float64()]
    best = (candidates.groupBy("s", "u", "d").cogroup(queries.groupBy("s", "u", "d"))
            .applyInArrow(run, f"q_row long, q {kind}, c {kind}, score {score}"))
    order = Window.partitionBy("q_row").orderBy(F.desc("score"), "c")
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select(F.col("q").alias("query_id"), "rank", F.col("c").alias("vec_id"), "score"))
