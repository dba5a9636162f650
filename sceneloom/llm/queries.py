"""Queries of the training-data operators, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import centroids, chat, content, decontam, divergence, langid, mixing, ngram_join, packing, quality, sharding, spotsigs, warc
from .common import table

CONTROL = "<|im_end|><|im_start|>assistant ok"


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL).alias("text"))
    return chat.digests(chat.format_conversations(rows.unionByName(planted)))


ORACLE_OP1 = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-1, 0, 'user', '{CONTROL}'), (-1, 1, 'assistant', '{CONTROL}')),
e AS (SELECT *, replace(replace(text, '\\', '\\\\'), '<|', '<\\|') AS et, replace(replace(replace(role, '\\', '\\\\'), '<|', '<\\|'), chr(10), '\\n') AS er FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(er) + length(et) + length('<|im_start|>') + length('<|im_end|>') + 2) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id"""


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_warc_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = warc.archive_round_trip(table(spark, sf_dir, "pages"))
    return pages.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE_OP3 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, CAST(CAST(unhex(sha1(coalesce(html, ''))) AS BIT) AS VARCHAR) AS b FROM pages),
d AS (SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes,
             array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               CAST(16 * CAST(substr(b, 5 * i + 1, 1) AS INTEGER) + 8 * CAST(substr(b, 5 * i + 2, 1) AS INTEGER) + 4 * CAST(substr(b, 5 * i + 3, 1) AS INTEGER)
               + 2 * CAST(substr(b, 5 * i + 4, 1) AS INTEGER) + CAST(substr(b, 5 * i + 5, 1) AS INTEGER) AS INTEGER) + 1, 1)), '') AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to FROM f"""


def op4_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content.extract_text(table(spark, sf_dir, "pages"))


def op5_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.fingerprint_documents(table(spark, sf_dir, "documents"))


def op5_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5's search: every document whose id is divisible by 100 against all, partitioned and pruned by length."""
    return spotsigs.nearest(table(spark, sf_dir, "documents"))


def op6_quality_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents")).drop("key")


def op8_shard_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op11_elkan_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_pack_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_format": op1_chat_format,
    "op2_decontaminate": op2_decontaminate,
    "op3_warc_normalise": op3_warc_normalise,
    "op4_html_extract": op4_html_extract,
    "op5_spotsigs": op5_spotsigs,
    "op5_nearest": op5_nearest,
    "op6_quality_pu": op6_quality_pu,
    "op7_ngram_join": op7_ngram_join,
    "op8_shard_tree": op8_shard_tree,
    "op9_mix_sources": op9_mix_sources,
    "op10_language_id": op10_language_id,
    "op11_elkan_centroids": op11_elkan_centroids,
    "op12_source_divergence": op12_source_divergence,
    "op13_pack_windows": op13_pack_windows,
}
ORACLE_SQL: dict[str, str] = {
    "op1_chat_format": ORACLE_OP1,
    "op3_warc_normalise": ORACLE_OP3,
    "op7_ngram_join": ngram_join.ORACLE,
    "op8_shard_tree": sharding.oracle(),
    "op9_mix_sources": mixing.ORACLE,
    "op11_elkan_centroids": centroids.oracle(),
    "op12_source_divergence": divergence.ORACLE,
}
