"""Registered queries of the training-data operators and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hotbeat.llm import (ann, fill_middle, html_text, jaccard_join, license_scan, matrix_bpe, packing, pieces, quality, token_store,
                         topk, toxicity, whitening)
from hotbeat.llm.common import held_out, table

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
MULTI_BPE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, written as shards and read back through the perfect hash index."""
    docs = table(spark, sf_dir, "documents")
    store = token_store.write_store(docs, WORD_BPE, "word", end_id=2)
    found = token_store.locate(store, docs.select("doc_id"))
    return token_store.read_digests(store, found).select("doc_id", "start", "n_tokens", "ids_crc32")


@query
def op7_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten largest integer inner products of every hundredth vector among all vectors."""
    return topk.top_k_inner_products(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, 10)


ORACLE["op7_exact_top_k"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_inner_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 10
"""


@query
def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty nearest of every twentieth vector among all vectors."""
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, 20)


ORACLE["op8_nearest"] = """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 20
"""


@query
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence labels of every document by base phrases and signature rules."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return license_scan.scan(docs).drop("text")


ORACLE["op10_license_scan"] = license_scan.oracle()


@query
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 tokens."""
    pieces = packing.pack(table(spark, sf_dir, "documents"), BYTE_BPE, "byte", end_id=0, length=1024)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by compression distance."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return (toxicity.score(docs.select("doc_id", "text"), model, column="score")
            .select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")))


@query
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by gated attention over its passages."""
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return (quality.score(docs.select("doc_id", "text"), model, column="score")
            .select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")))


@query
def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(table(spark, sf_dir, "pages"))


@query
def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document."""
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every document and the crc32 of the text that they decode to."""
    encoded = pieces.encode(table(spark, sf_dir, "documents"), PIECE_BPE)
    return (pieces.decode(encoded, PIECE_BPE)
            .select("doc_id", (F.length("ids") / 2).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"),
                    F.length("text").cast("long").alias("n_chars"), F.crc32(F.col("text").cast("binary")).alias("text_crc32")))


@query
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First four whitened components of every embedding."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=4)


@query
def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every document, and the bytes that they decode to."""
    encoded = matrix_bpe.encode(table(spark, sf_dir, "documents"), MULTI_BPE)
    return (matrix_bpe.decode(encoded, MULTI_BPE)
            .select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                    F.sha2("decoded", 256).alias("decoded_sha256")))


@query
def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document rearranged for filling in its middle, and restored from that."""
    done = fill_middle.transform(table(spark, sf_dir, "documents"))
    keep = ["doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256")]
    return fill_middle.restore(done, *keep).select(*done.columns[:5], "output_sha256", F.sha2("restored", 256).alias("restored_sha256"))


ORACLE["op13_fill_middle"] = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || CAST(doc_id AS VARCHAR)) AS h FROM documents),
k AS (
  SELECT doc_id, t, length(t) AS n,
         CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
  FROM d),
c AS (
  SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM k),
p AS (
  SELECT *, substring(t, 1, a) AS prefix, substring(t, a + 1, b - a) AS middle, substring(t, b + 1) AS suffix FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(a AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(b - a AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""


QUERIES["pipeline"] = corpus_pipeline.run
