"""Helpers that several training-data operators share."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hotbeat.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """The rows of ``df``, computed once into a Parquet table in the shared folder and read back.

    Cuts the lineage: after the loss of executors only the reading tasks run again.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_system(uri: str):
    """(file system, path) of a shared folder, for files that tasks write or seek in themselves."""
    from pyarrow import fs

    uri = re.sub(r"^file:/+", "file:///", uri)
    return fs.FileSystem.from_uri(uri)


def held_out(doc_id="doc_id"):
    """Rows whose labels may not be learnt from: crc32 of the id as text, mod 5, is 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


#: Characters of a document that are learnt from; of a longer one, ``SPREAD`` parts of equal size and distance.
LONGEST_LEARNT = 100_000
SPREAD = 10


def _known(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, y) of the documents of the input whose label may be learnt."""
    known = (labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
             .groupBy("doc_id").agg(F.max(label).cast("int").alias("y")))
    return known.join(docs.select("doc_id"), "doc_id", "left_semi")


def label_counts(docs: DataFrame, labels: DataFrame, label: str) -> dict[int, int]:
    """{label: documents of the input that have it}, held-out ones excluded."""
    return {r["y"]: r["count"] for r in _known(docs, labels, label).groupBy("y").count().collect()}


def training_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> list[tuple[str, int]]:
    """(text, label) of at most ``per_class`` labelled documents of each label, held-out ones excluded.

    The documents are those of the input with the smallest hashes of their id: a fixed, unbiased choice
    whatever the partitioning.  Only this sample reaches the driver; it is bounded in rows and, by
    ``LONGEST_LEARNT``, in characters: a longer text is learnt from ten parts spread over all of it.
    """
    known = _known(docs, labels, label).withColumn("h", F.xxhash64("doc_id", F.lit(7)))
    ids = [(r["doc_id"], r["y"]) for y in (0, 1) for r in known.where(F.col("y") == y).orderBy("h", "doc_id").limit(per_class).collect()]
    if not ids:
        return []
    kind = docs.schema["doc_id"].dataType.simpleString()
    chosen = docs.sparkSession.createDataFrame(ids, f"doc_id {kind}, y int")  # 2 * per_class rows at most
    size = F.length("text")
    spread = F.concat_ws(" ", *[F.substring("text", F.floor(size * i / SPREAD).cast("int") + 1, F.lit(LONGEST_LEARNT // SPREAD)) for i in range(SPREAD)])
    rows = (docs.select("doc_id", F.when(size > LONGEST_LEARNT, spread).otherwise(F.col("text")).alias("text")).join(F.broadcast(chosen), "doc_id")
            .groupBy("doc_id", "y").agg(F.min("text").alias("text")).orderBy("doc_id").select("text", "y").collect())
    return [(r["text"] or "", r["y"]) for r in rows]
