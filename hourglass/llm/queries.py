"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourglass.llm import (
    alignment,
    automata,
    exact_dedup,
    hard_negatives,
    langid,
    mixing,
    nndescent,
    packing,
    simhash,
    simple8b,
    sos_packing,
    suffix_dedup,
    warc,
)
from hourglass.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return exact_dedup.exact_classes(docs, keep="max").select(
        F.col("_id").alias("doc_id"),
        F.col("_keep").alias("keep_id"),
        F.col("_n").alias("group_size"),
        "kept",
        F.lower(F.hex("_sha")).alias("text_sha256"),
    )


ORACLE["op6_exact_dedup"] = """
SELECT doc_id,
       max(doc_id) OVER w AS keep_id,
       count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW w AS (PARTITION BY coalesce(text, ''))
"""


@query
def op10_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return simhash.simhash_classes(docs, shingle=3, max_bits=2).select(
        F.col("_id").alias("doc_id"),
        F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


@query
def op1_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return packing.pack_documents(docs, end_id=0, keep_ids=False).drop("ids", "loss_tokens")


@query
def op9_simple8b_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return simple8b.read_token_files(simple8b.write_token_files(docs, end_id=2))


@query
def op3_mix_to_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text", "source", "lang"])
    return mixing.mix(docs, rounds=mixing.ROUNDS).select(
        F.col("_id").alias("doc_id"), F.col("_source").alias("source"), F.col("_lang").alias("lang"),
        F.col("_topic").alias("topic"), F.col("_tokens").alias("tokens"),
        F.round("probability", 6).alias("probability"), "sampled",
    )


ORACLE["op3_mix_to_targets"] = mixing.oracle()


@query
def op5_ecoc_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text", "lang"])
    learn = langid.learnable("doc_id")
    model = langid.train(docs.filter(learn))
    found = langid.identify(docs.select("doc_id", "text"), model)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "ambiguous")


@query
def op8_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages", ["page_id", "url", "html"])
    return warc.read_warc(warc.write_warc(pages)).drop("url")


ORACLE["op8_warc_revisits"] = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id < last THEN last END AS refers_to
FROM g
"""


@query
def op2_automaton_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return automata.remove_repeats(docs, width=20).select(
        F.col("_id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


@query
def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return suffix_dedup.remove_repeats(docs, width=100).select(
        F.col("_id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query
def op7_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    vecs = read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding"])
    return nndescent.nearest(vecs, F.col("id") % 20 == 0, top=20)


@query
def op11_interval_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return alignment.aligned(docs)


@query
def op12_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return sos_packing.pack_documents(docs, end_id=1, capacity=4096, keep_ids=False).drop("ids")


@query
def op13_threshold_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vecs = read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding", "label"])
    moved = F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vecs, F.col("id") % 100 == 0, relabel=moved)


ORACLE["op13_threshold_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_inner_product(a.q, c.q) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
r AS (
  SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank,
         vec_id AS negative_id, positive_score, score AS negative_score
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
    AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM r WHERE rank <= 10
"""
