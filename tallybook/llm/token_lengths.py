"""Exact histogram of encoded lengths, and what its suffix sums answer.

One pass encodes every text and counts documents by length. The histogram has a row for each
length that occurs, and its suffix sums give totals, quantiles and the tokens left after
truncation to any context limit, without another look at the texts.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import partial

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybook.llm.secret_scan import load_encoding
from tallybook.llm.shared import checkpointed, per_batch, require_columns

#: Lengths of one bin; suffix sums run inside bins and over the totals of bins.
BIN = 1024


#: The encoder's own splitting fails on runs of white space of some 300,000 characters.
LONG_GAP = re.compile(r"\s{100000}")


def token_count(encoding: tiktoken.Encoding, text: str, pattern: str) -> int:
    """How many tokens the encoder makes of a text.

    A text with a very long run of white space is cut into the same pieces by another engine for
    the pattern, and each piece is encoded by itself.
    """
    if LONG_GAP.search(text) is None:
        return len(encoding.encode_ordinary(text))
    pieces = (match[0] for match in regex.finditer(pattern, text))
    return sum(len(encoding._encode_single_piece(piece)) for piece in pieces)


def _lengths(
    batch: pa.RecordBatch, vocabulary: str, pattern: str, encoding: list
) -> pa.RecordBatch:
    if not encoding:
        encoding.append(load_encoding(vocabulary, pattern))
    counts: dict[int, int] = {}
    for text in batch.column(0).to_pylist():
        n = token_count(encoding[0], text, pattern) if text else 0
        counts[n] = counts.get(n, 0) + 1
    return pa.RecordBatch.from_arrays(
        [pa.array(counts.keys(), pa.int64()), pa.array(counts.values(), pa.int64())],
        names=["n_tokens", "n_docs"],
    )


def length_histogram(
    docs: DataFrame, vocabulary: str, pattern: str, text: str = "text"
) -> DataFrame:
    """(n_tokens, n_docs): how many documents have each encoded length.

    A null text has length 0 like an empty one. Texts are encoded whole; repeated rows count
    each time; an empty table gives no rows; other columns are ignored. Tasks send a row for
    each batch and length, combined before the shuffle. The histogram is stored, so that what is
    asked of it later does not encode again.
    """
    require_columns(docs, text)
    lengths = docs.select(docs[text]).mapInArrow(
        per_batch(partial(_lengths, vocabulary=vocabulary, pattern=pattern, encoding=[])),
        "n_tokens bigint, n_docs bigint",
    )
    return checkpointed(lengths.groupBy("n_tokens").agg(F.sum("n_docs").alias("n_docs")))


def with_suffix_sums(histogram: DataFrame) -> DataFrame:
    """The histogram with what holds at and beyond each length.

    docs_from, tokens_from: documents of at least this length, and their tokens.
    truncated_tokens: tokens of all documents cut to this length as context limit.
    quantile: share of documents that are at most this long.
    """
    binned = histogram.withColumn("bin", F.floor(F.col("n_tokens") / BIN))
    bins = binned.groupBy("bin").agg(
        F.sum("n_docs").alias("docs"), F.sum(F.col("n_docs") * F.col("n_tokens")).alias("tokens")
    )
    # As many rows as there are bins, that is the longest length / 1024 at most.
    later = Window.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.desc("bin")).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    bins = bins.select(
        "bin",
        F.coalesce(F.sum("docs").over(later), F.lit(0)).alias("docs_later"),
        F.coalesce(F.sum("tokens").over(later), F.lit(0)).alias("tokens_later"),
        F.sum("docs").over(everything).alias("all_docs"),
        F.sum("tokens").over(everything).alias("all_tokens"),
    )
    inside = Window.partitionBy("bin").orderBy(F.desc("n_tokens"))
    summed = binned.join(bins, "bin").select(
        "n_tokens",
        "n_docs",
        (F.sum("n_docs").over(inside) + F.col("docs_later")).alias("docs_from"),
        (F.sum(F.col("n_docs") * F.col("n_tokens")).over(inside) + F.col("tokens_later")).alias(
            "tokens_from"
        ),
        "all_docs",
        "all_tokens",
    )
    return summed.select(
        "n_tokens",
        "n_docs",
        "docs_from",
        "tokens_from",
        (F.col("all_tokens") - F.col("tokens_from") + F.col("n_tokens") * F.col("docs_from")).alias(
            "truncated_tokens"
        ),
        ((F.col("all_docs") - F.col("docs_from") + F.col("n_docs")) / F.col("all_docs")).alias(
            "quantile"
        ),
    )


def truncated_totals(histogram: DataFrame, limits: Sequence[int]) -> DataFrame:
    """(context_limit, docs_cut, tokens): what is left when texts are cut to each limit."""
    cut = F.col("n_tokens") > F.col("context_limit")
    return (
        histogram.withColumn("context_limit", _each(limits, "long"))
        .groupBy("context_limit")
        .agg(
            F.sum(F.when(cut, F.col("n_docs")).otherwise(0)).alias("docs_cut"),
            F.sum(F.col("n_docs") * F.least("n_tokens", "context_limit")).alias("tokens"),
        )
    )


def _each(values: Sequence[float], kind: str) -> Column:
    if not values:
        raise ValueError("no values given")
    return F.explode(F.array(*[F.lit(value).cast(kind) for value in values]))


def length_quantiles(histogram: DataFrame, quantiles: Sequence[float]) -> DataFrame:
    """(quantile, n_tokens): the shortest length that this share of documents does not exceed."""
    sums = with_suffix_sums(histogram)
    wanted = sums.withColumnRenamed("quantile", "reached").withColumn(
        "quantile", _each(quantiles, "double")
    )
    return (
        wanted.where(F.col("reached") >= F.col("quantile"))
        .groupBy("quantile")
        .agg(F.min("n_tokens").alias("n_tokens"))
    )
