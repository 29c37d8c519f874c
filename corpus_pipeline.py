"""Filters, decontaminates, mixes and shards ``documents``, one stage after the other.

Every stage takes (spark, docs, sf_dir), works on all documents that the one before kept and
returns a DataFrame, which is written as Parquet and read again for the next. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.llm.entropy_mix import Mix, mixed_rows
from tallybook.llm.jaccard_join import Join, similar_components, text_key
from tallybook.llm.ring_shards import Ring, ring_shards
from tallybook.llm.shared import checkpointed
from tallybook.llm.template_leaks import Leaks, without_leaks
from tallybook.llm.toxic_kernel import Kernel, fit, score_documents


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half, by the labels of the table ``labels``.

    Whole texts are scored. Documents with a null or empty text stay, rows that repeat and rows
    without an id are judged like any others, and columns may have any names. No documents give
    none, and without labels of both kinds all stay.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fit(docs, labels, Kernel())
    name = _unused("score", docs)
    return score_documents(docs, model, name=name).where(F.col(name) < 0.5).select(*docs.columns)


def _unused(name: str, docs: DataFrame) -> str:
    while name in docs.columns:
        name += "_"
    return name


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents the one with the smallest id.

    Documents without words are similar to nothing and stay. Rows that repeat an id are one
    document, and of them one with the smallest hash of its text stays. Of rows without an id
    those go that are similar to a document with one, and of equal ones among the rest one stays.
    Columns may have any names, and no documents give none.
    """
    del spark, sf_dir
    groups = checkpointed(similar_components(docs, Join(words=5, percent=80)))
    kept = groups.where("doc_id = component_id").groupBy("doc_id").agg(F.min("text_key").alias("key"))
    nameless = groups.where("doc_id is null and component_id is null").select(
        "doc_id", F.col("text_key").alias("key")
    )
    stay = kept.unionByName(nameless.distinct()).toDF("kept_id", "kept_key")
    # In one struct, the given columns clash with nothing.
    given = docs.select(F.struct("*").alias("given"), "doc_id", text_key("text").alias("key"))
    same = F.expr("doc_id <=> kept_id AND key = kept_key")
    # Dealt by id and text, so that dropping rows that repeat both deals no more.
    return (
        given.join(stay, same, "left_semi").dropDuplicates(["doc_id", "key"]).select("given.*")
    )


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the table ``benchmark``.

    Documents with a null or empty text stay, rows that repeat are judged alike, and columns may
    have any names. No documents give none, and without items all stay.
    """
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return without_leaks(docs, items, Leaks(window=8, words=13))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them, each copy a row.

    Documents without words are taken once, those without a source are one of their own, rows
    that repeat are taken alike, and columns may have any names. No documents give none.
    """
    del spark, sf_dir
    copies = F.explode(F.expr("array_repeat(0, CAST(copies AS INT))")).alias("copy")
    return mixed_rows(docs, Mix()).select("given", copies).select("given.*")


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row.

    A null text has no bytes, and rows that repeat, also without an id, each get a slot of their
    own. Other columns are left out, and no documents give none.
    """
    del spark, sf_dir
    return ring_shards(docs, Ring(shards=16)).select(
        "doc_id", "size", "text_crc32", "shard", "slot"
    )


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: A trained model and a search of components are not expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to the table ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = checkpointed(docs)
    return docs
