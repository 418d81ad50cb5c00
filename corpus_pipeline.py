"""Training corpus from raw documents: toxicity, quality, near duplicates, packing.

``STAGES`` are (name, function) pairs; each function takes (spark, docs, sf_dir) and works on all that
its predecessor kept.  All but the last return the columns of ``documents``; the last returns one row
a piece of a packed sequence.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hotbeat.llm import jaccard_join, packing, quality, toxicity
from hotbeat.llm.common import table, written
from hotbeat.session import ensure_checkpoint_dir, ship_package

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
TOXIC_FROM = 0.5
QUALITY_FROM = 0.3


def _ready(spark: SparkSession) -> None:
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.5.  Null and empty texts are scored like any."""
    _ready(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, column="_toxicity").where(F.col("_toxicity") < TOXIC_FROM).drop("_toxicity")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is 0.3 or more.  Null and empty texts are scored like any."""
    _ready(spark)
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model, column="_quality").where(F.col("_quality") >= QUALITY_FROM).drop("_quality")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group of near duplicates, once if its row is repeated.

    Rows are told apart by a hash of id and text, so an id may stand on several texts; rows without an id
    come last in their group.  Empty texts are linked with nothing and stay, without an id all of them.
    """
    _ready(spark)
    keyed = docs.withColumn("_row", F.xxhash64("doc_id", "text", F.isnull("doc_id"), F.isnull("text")))
    groups = jaccard_join.near_duplicates(keyed.select(F.col("_row").alias("doc_id"), "text"))
    groups = groups.select(F.col("doc_id").alias("_row"), "n_shingles", "component_id").distinct()
    ids = keyed.select("_row", "doc_id").distinct()
    best = F.min(F.struct(F.isnull("doc_id").alias("none"), F.col("doc_id"), F.col("_row"), F.col("n_shingles"))).alias("_best")
    chosen = groups.join(ids, "_row").groupBy("component_id").agg(best).select("_best._row", "_best.none", "_best.n_shingles")
    chosen = written(chosen, "corpus-chosen")
    whole = F.col("none") & (F.col("n_shingles") == 0)
    once = keyed.join(chosen.where(~whole).select("_row"), "_row", "left_semi").dropDuplicates(["_row"])
    return once.unionByName(keyed.join(chosen.where(whole).select("_row"), "_row", "left_semi")).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 1024 tokens, every id of every document in exactly one."""
    _ready(spark)
    return (packing.pack(docs, BYTE_BPE, "byte", end_id=0, length=1024)
            .select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"))


STAGES = [("toxicity", drop_toxic), ("quality", keep_quality), ("near_duplicates", one_of_each_group), ("packing", pack)]

#: Classifiers and packing are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    _ready(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
