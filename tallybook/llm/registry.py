"""Registered queries of the numbered operators: thin adapters to their fixed columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.llm import oracles
from tallybook.llm.chat_format import conversation_digests, events_of_turns, format_conversations
from tallybook.llm.entropy_mix import Mix, mix_sources
from tallybook.llm.filter_audit import audit_filters
from tallybook.llm.html_text import extract_main_text
from tallybook.llm.jaccard_join import Join, similar_components
from tallybook.llm.near_vectors import Buckets, link_vectors
from tallybook.llm.pivot_clusters import Clusters, cluster_vectors
from tallybook.llm.repeated_windows import remove_repeated_windows
from tallybook.llm.ring_shards import Ring, ring_shards
from tallybook.llm.secret_scan import SecretScan, find_secrets
from tallybook.llm.token_lengths import length_histogram, with_suffix_sums
from tallybook.llm.template_leaks import Leaks, find_leaks
from tallybook.llm.toxic_kernel import Kernel, fit, score_documents

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_vectors(_table(spark, sf_dir, "embeddings"), Buckets(cosine=0.98))


def op2_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(_table(spark, sf_dir, "documents"), Mix())
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(_table(spark, sf_dir, "pages"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scan = SecretScan(VOCABULARY, PATTERN)
    return find_secrets(_table(spark, sf_dir, "documents"), scan).drop("values")


def op5_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = ring_shards(_table(spark, sf_dir, "documents"), Ring(shards=16))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_token_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return with_suffix_sums(length_histogram(docs, VOCABULARY, PATTERN))


def op7_toxic_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    scored = score_documents(docs.select("doc_id", "text"), fit(docs, labels, Kernel()))
    return scored.select(
        "doc_id",
        (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op8_repeated_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = remove_repeated_windows(_table(spark, sf_dir, "documents"), window=13)
    return docs.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op9_template_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    found = find_leaks(docs, items, Leaks(window=8, words=13))
    return found.select("doc_id", "item_id", "n_words", "item_words", "exact")


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = similar_components(_table(spark, sf_dir, "documents"), Join(words=5, percent=80))
    return found.select("doc_id", "n_shingles", "component_id")


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Conversation -1 says what templates are made of.
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    turns = _table(spark, sf_dir, "conversations").select(*probe.columns).unionByName(probe)
    return conversation_digests(format_conversations(events_of_turns(turns)))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    audited = audit_filters(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return audited.drop("filter")


def op13_pivot_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(_table(spark, sf_dir, "embeddings"), Clusters())


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_near_vectors,
            op2_entropy_mix,
            op3_html_text,
            op4_secret_scan,
            op5_ring_shards,
            op6_token_lengths,
            op7_toxic_kernel,
            op8_repeated_windows,
            op9_template_leaks,
            op10_jaccard_join,
            op11_chat_format,
            op12_filter_audit,
            op13_pivot_clusters,
        )
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_near_vectors": oracles.NEAR_VECTORS,
        "op8_repeated_windows": oracles.REPEATED_WINDOWS,
        "op10_jaccard_join": oracles.JACCARD_JOIN,
        "op11_chat_format": oracles.CHAT_FORMAT,
        "op12_filter_audit": oracles.FILTER_AUDIT,
        "op13_pivot_clusters": oracles.pivot_clusters(),
    }
