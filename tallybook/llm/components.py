"""Connected components of a graph that is given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.shared import checkpointed


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node in edges (a, b): the smallest node it is connected to.

    Alternates two steps until nothing changes: every node hands its larger neighbours to the
    smallest node it knows, then its smaller ones. Paths halve, as in pointer jumping, and
    both steps are a minimum combined before the shuffle and an equi-join, so that a node with
    many neighbours is not gathered anywhere. Null ends are ignored.
    """
    current = checkpointed(
        edges.where("a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )
    known = None
    while True:
        current = checkpointed(_smaller_star(_larger_star(current)))
        state = current.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == known:
            break
        known = state
    # Now every edge joins a node with the smallest of its component.
    return current.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(
        current.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    )


def _larger_star(edges: DataFrame) -> DataFrame:
    """Edges (a, b), a < b: each larger neighbour of a node now hangs on its smallest one."""
    smallest = edges.groupBy(F.col("b").alias("n")).agg(F.min("a").alias("m"))
    # Of a node's neighbours the larger ones are the b of its edges as a.
    return (
        edges.join(smallest, edges["a"] == smallest["n"], "left")
        .select(F.coalesce("m", "a").alias("a"), "b")
        .distinct()
    )


def _smaller_star(edges: DataFrame) -> DataFrame:
    """Each smaller neighbour of a node, and the node, now hang on the smallest one."""
    smallest = edges.groupBy(F.col("b").alias("n")).agg(F.min("a").alias("m"))
    joined = edges.join(smallest, edges["b"] == smallest["n"])
    return (
        joined.where("a <> m")
        .select(F.col("m").alias("a"), F.col("a").alias("b"))
        .unionByName(smallest.select(F.col("m").alias("a"), F.col("n").alias("b")))
        .distinct()
    )
