"""Helpers of the operators: the shared folder, and words and hashes of Arrow batches."""

from __future__ import annotations

import sys
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Functions that run in tasks travel with the job, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__.partition(".")[0]])

WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """A new path in the folder that all executors share.

    A cluster names the folder in spark.checkpoint.dir; where it is unset, a local session, as in
    tests, gets a temporary one, and any other is refused: executors would not see each other's
    files. Its owner clears it, as with any checkpoint.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = context.getConf().get("spark.checkpoint.dir")
        if not named and context.master.partition("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="tallybook-"))
    return f"{context.getCheckpointDir()}/{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once, written to the shared folder and read back.

    A table, not DataFrame.checkpoint(): what reads it gets its size, unused columns are not
    read, and no predicates of the old plan are carried along through iterations.
    """
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def require_columns(df: DataFrame, *names: str) -> None:
    """Fail early and by name, not in a task."""
    if missing := [name for name in names if name not in df.columns]:
        raise ValueError(f"missing columns {missing}; there are {df.columns}")


def n_words(text: Column | str) -> Column:
    """Number of words separated by ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)).cast("long"), F.lit(0).cast("long"))


def per_batch(
    function: Callable[[pa.RecordBatch], pa.RecordBatch],
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``function`` of one batch as a function for mapInArrow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield function(batch)

    return run


def of_group(function: Callable[..., pa.Table], **given) -> Callable[[tuple, pa.Table], pa.Table]:
    """``function`` of a key and a table, as groupBy().applyInArrow takes it."""
    return lambda key, table: function(key, table, **given)


def of_cogroup(
    function: Callable[..., pa.Table], **given
) -> Callable[[tuple, pa.Table, pa.Table], pa.Table]:
    """``function`` of a key and two tables, as cogroup().applyInArrow takes it."""
    return lambda key, left, right: function(key, left, right, **given)
