"""Clusters around centroids, exact, with most distances ruled out by Ptolemy's inequality.

For any four points, d(x, c) * d(p, s) >= |d(x, p) * d(c, s) - d(x, s) * d(c, p)|. With fixed
pivots p and s and the distances of a vector to them kept beside it, every pair of pivots gives a
lower bound of its distance to every centroid, without a look at its components. The centroid
with the least bound is measured exactly; only those whose bound does not exceed that distance
are measured, too. Vectors are integers, so distances compare exactly, while bounds are floating
point and lowered by more than their rounding can be.

A round is one pass: tasks keep a count and a sum of components for each cluster, and the driver
gets as many rows as there are centroids.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.chunks import combined
from tallybook.llm.shared import checkpointed, require_columns

#: Components beyond these could make a squared distance of a long that is none.
LARGEST = 1 << 27
#: Rows that are compared at a time.
ROWS = 2048
#: A bound is a few roundings of 2^-53 off, each relative to a product of two distances.
SLACK = 1e-12


@dataclass(frozen=True)
class Clusters:
    """count: centroids. dimension: of the vectors. scale: components are floor(scale * x).

    rounds: how often centroids move. pivots, pairs: how many pivots there are, and pairs of
    them that give bounds. prefix: hashed in front of an id to choose the first centroids.
    """

    count: int = 40
    dimension: int = 64
    scale: int = 256
    rounds: int = 5
    pivots: int = 8
    pairs: int = 12
    prefix: str = "2:"

    def __post_init__(self) -> None:
        if min(self.count, self.dimension, self.scale, self.pairs) < 1 or self.pivots < 2:
            raise ValueError(f"not a set of clusters: {self}")


def whole_vectors(vectors: DataFrame, clusters: Clusters) -> DataFrame:
    """(vec_id, x): the vectors that count, with whole components.

    Those of another length, or with a null or non-finite component, are left out. One so large
    that squared distances would be no long raises.
    """
    require_columns(vectors, "vec_id", "embedding")
    finite = F.expr(
        f"embedding is not null AND size(embedding) = {clusters.dimension} AND "
        "forall(embedding, x -> x is not null AND NOT isnan(x) AND abs(x) != double('infinity'))"
    )
    scaled = F.transform("embedding", lambda x: F.lit(float(clusters.scale)) * x.cast("double"))
    # A double that is out of range of a long is out of this range, too.
    return vectors.where(finite).select(
        "vec_id",
        F.transform(
            scaled,
            lambda x: F.when(F.abs(x) < LARGEST, F.floor(x)).otherwise(
                F.raise_error(F.lit(f"a component beyond {LARGEST} / {clusters.scale}"))
            ),
        ).cast("array<int>").alias("x"),
    )


def first_centroids(whole: DataFrame, clusters: Clusters) -> np.ndarray:
    """As many vectors as there are centroids, by the hash of their ids; fewer if there are fewer.

    Null ids are hashed as no text, and rows with equal ids are ordered by their components.
    """
    hashed = F.sha2(
        F.concat(F.lit(clusters.prefix), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256
    )
    rows = whole.select(hashed.alias("h"), "x").orderBy("h", "x").limit(clusters.count).collect()
    return np.array([r["x"] for r in rows], dtype=np.int64).reshape(-1, clusters.dimension)


def choose_pivots(points: np.ndarray, clusters: Clusters) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Points that are far from each other, and the pairs of them that are the farthest."""
    points = np.unique(points, axis=0)
    if len(points) < 2:
        return points[:0], []
    chosen = [0]
    nearest = squared(points, points[:1])[:, 0]
    while len(chosen) < min(clusters.pivots, len(points)):
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, squared(points, points[chosen[-1:]])[:, 0])
    pivots = points[chosen]
    apart = squared(pivots, pivots)
    pairs = sorted(combinations(range(len(pivots)), 2), key=lambda p: (-apart[p], p))
    return pivots, pairs[: clusters.pairs]


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of every row of x to every row of y, all whole numbers."""
    found = np.empty((len(x), len(y)), dtype=np.int64)
    for j in range(len(y)):
        gap = x - y[j]
        found[:, j] = np.einsum("ij,ij->i", gap, gap)
    return found


def lower_bounds(
    to_pivots: np.ndarray, centroids: np.ndarray, pivots: np.ndarray, pairs: list[tuple[int, int]]
) -> np.ndarray:
    """(row, centroid): squared distances that no true one is below."""
    found = np.zeros((len(to_pivots), len(centroids)))
    if not pairs:
        return found
    from_centroids = np.sqrt(squared(centroids, pivots).astype(np.float64))
    apart = np.sqrt(squared(pivots, pivots).astype(np.float64))
    for p, s in pairs:
        one = to_pivots[:, p, None] * from_centroids[None, :, s]
        other = to_pivots[:, s, None] * from_centroids[None, :, p]
        # Rounding is relative to the products, not to their difference.
        bound = (np.abs(one - other) - SLACK * (one + other)) / apart[p, s]
        np.maximum(found, bound, out=found)
    return found * found * (1 - SLACK)


def nearest(
    x: np.ndarray,
    to_pivots: np.ndarray,
    centroids: np.ndarray,
    pivots: np.ndarray,
    pairs: list[tuple[int, int]],
) -> tuple[np.ndarray, np.ndarray, int]:
    """The nearest centroid of each row, the smallest of ties, its squared distance, and how
    many distances were measured."""
    bounds = lower_bounds(to_pivots, centroids, pivots, pairs)
    rows = np.arange(len(x))
    guess = bounds.argmin(axis=1)
    gap = x - centroids[guess]
    best = np.einsum("ij,ij->i", gap, gap)
    # Equal distances survive, so that the smaller number can win. A distance as a double may
    # lie below itself by its rounding.
    row, centroid = np.nonzero(bounds <= best[:, None] * (1 + SLACK))
    gap = x[row] - centroids[centroid]
    distance = np.einsum("ij,ij->i", gap, gap)
    all_of = np.full((len(x), len(centroids)), np.iinfo(np.int64).max)
    all_of[row, centroid] = distance
    # The guess is among those that were measured; argmin takes the first of equal ones.
    cluster = all_of.argmin(axis=1)
    return cluster, all_of[rows, cluster], len(row)


def _components(column: pa.Array | pa.ChunkedArray, dimension: int) -> np.ndarray:
    flat = combined(column) if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)


def _with_pivots(batches: Iterator[pa.RecordBatch], pivots: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The vectors with their distances to the pivots."""
    for batch in batches:
        x = _components(batch.column("x"), pivots.shape[1]).astype(np.int64)
        to_pivots = np.sqrt(squared(x, pivots).astype(np.float64))
        width = len(pivots)
        lists = pa.ListArray.from_arrays(
            pa.array(np.arange(len(x) + 1) * width, pa.int32()), pa.array(to_pivots.ravel())
        )
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), batch.column("x"), lists], names=["vec_id", "x", "to_pivots"]
        )


def _assigned(
    batch: pa.RecordBatch, centroids: np.ndarray, pivots: np.ndarray, pairs: list[tuple[int, int]]
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, int]]:
    for start in range(0, batch.num_rows, ROWS):
        part = batch.slice(start, ROWS)
        x = _components(part.column("x"), centroids.shape[1]).astype(np.int64)
        to_pivots = _components(part.column("to_pivots"), max(len(pivots), 1))
        if not pairs:
            to_pivots = np.zeros((len(x), 0))
        cluster, distance, measured = nearest(x, to_pivots, centroids, pivots, pairs)
        yield start, len(x), x, cluster, distance, measured


def _sums(batches: Iterator[pa.RecordBatch], centroids: np.ndarray, **pruning) -> Iterator[pa.RecordBatch]:
    """Of a task: for each cluster its rows, how many distances were measured, and its sums."""
    counts = np.zeros(len(centroids), dtype=np.int64)
    sums = np.zeros(centroids.shape, dtype=np.int64)
    measured = 0
    for batch in batches:
        for _, _, x, cluster, _, some in _assigned(batch, centroids, **pruning):
            measured += some
            np.add.at(counts, cluster, 1)
            np.add.at(sums, cluster, x)
    used = np.flatnonzero(counts)
    if len(used):
        first = np.zeros(len(used), dtype=np.int64)
        first[0] = measured
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(used.astype(np.int32)),
                pa.array(counts[used]),
                pa.array(first),
                pa.array(sums[used].tolist(), pa.list_(pa.int64())),
            ],
            names=["cluster", "n", "measured", "sums"],
        )


def _final(batches: Iterator[pa.RecordBatch], centroids: np.ndarray, **pruning) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, length, _, cluster, distance, _ in _assigned(batch, centroids, **pruning):
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").slice(start, length),
                    pa.array(cluster.astype(np.int32)),
                    pa.array(distance),
                ],
                names=["vec_id", "cluster", "distance"],
            )


def moved_centroids(kept: DataFrame, centroids: np.ndarray, **pruning) -> tuple[np.ndarray, int]:
    """The means of the clusters, rounded down, and how many distances that took.

    Tasks send a row for each cluster, whose components Spark adds up as decimals: sums of any
    number of vectors are exact. An empty cluster keeps its centroid.
    """
    partial_sums = kept.select("x", "to_pivots").mapInArrow(
        partial(_sums, centroids=centroids, **pruning),
        "cluster int, n bigint, measured bigint, sums array<bigint>",
    )
    wide = F.col("value").cast("decimal(38,0)")
    count = F.sum(F.col("n").cast("decimal(38,0)"))
    found = (
        partial_sums.select("cluster", "n", "measured", F.posexplode("sums").alias("i", "value"))
        .groupBy("cluster", "i")
        .agg(
            F.sum(wide).alias("total"), count.alias("n"),
            F.sum(F.when(F.col("i") == 0, F.col("measured")).otherwise(0)).alias("measured"),
        )
        .collect()
    )
    moved = centroids.copy()
    for r in found:
        moved[r["cluster"], r["i"]] = int(r["total"]) // int(r["n"])
    return moved, sum(int(r["measured"]) for r in found)


def cluster_vectors(vectors: DataFrame, clusters: Clusters = Clusters()) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector.

    Vectors of another length, or with null or non-finite components, or none, have no row; see
    ``whole_vectors``. Rows that repeat count each, also with equal or null ids. With fewer
    vectors than centroids there are as many centroids as vectors, and equal centroids leave all
    but the first empty. An empty table gives no rows. Other columns are ignored.
    """
    whole = checkpointed(whole_vectors(vectors, clusters))
    centroids = first_centroids(whole, clusters)
    pivots, pairs = choose_pivots(centroids, clusters)
    id_type = whole.schema["vec_id"].dataType.simpleString()
    # The vectors with what bounds need are stored once and read by every round.
    measured = whole.mapInArrow(
        partial(_with_pivots, pivots=pivots.reshape(-1, clusters.dimension)),
        f"vec_id {id_type}, x array<int>, to_pivots array<double>",
    )
    kept = checkpointed(measured) if pairs else whole.withColumn("to_pivots", F.array(F.lit(0.0)))
    pruning = {"pivots": pivots, "pairs": pairs}
    for _ in range(clusters.rounds if len(centroids) else 0):
        centroids, _ = moved_centroids(kept, centroids, **pruning)
    assigned = checkpointed(
        kept.mapInArrow(
            partial(_final, centroids=centroids, **pruning),
            f"vec_id {id_type}, cluster int, distance bigint",
        )
    )
    # One row for each centroid, clusters.count at most.
    wide = F.sum(F.col("distance").cast("decimal(38,0)")).alias("sum")
    sums = {r["cluster"]: int(r["sum"]) for r in assigned.groupBy("cluster").agg(wide).collect()}
    told = vectors.sparkSession.createDataFrame(
        [
            (i, sums[i], sum(sums.values()), ",".join(map(str, row)))
            for i, row in enumerate(centroids.tolist())
            if i in sums
        ],
        "cluster int, cluster_inertia bigint, inertia bigint, components string",
    ).withColumn("centroid_sha256", F.sha2("components", 256))
    return assigned.join(F.broadcast(told), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
