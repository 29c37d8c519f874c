"""Clusters against measuring every distance, and bounds against the distances."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallybook.llm.pivot_clusters import (
    LARGEST,
    Clusters,
    choose_pivots,
    cluster_vectors,
    first_centroids,
    lower_bounds,
    moved_centroids,
    nearest,
    squared,
    whole_vectors,
)

SCHEMA = "vec_id bigint, embedding array<double>"


def plain(rows, c):
    """Every distance, in whole numbers of Python."""
    kept = [
        (i, [int(np.floor(c.scale * float(v))) for v in x])
        for i, x in rows
        if x is not None and len(x) == c.dimension and all(v is not None and np.isfinite(v) for v in x)
    ]
    name = lambda i: "" if i is None else str(i)
    ordered = sorted(kept, key=lambda r: (hashlib.sha256(f"{c.prefix}{name(r[0])}".encode()).hexdigest(), r[1]))
    centroids = [x for _, x in ordered[: c.count]]

    def assign():
        found = []
        for _, x in kept:
            d = [sum((a - b) ** 2 for a, b in zip(x, y, strict=True)) for y in centroids]
            found.append((d.index(min(d)), min(d)))
        return found

    for _ in range(c.rounds):
        members = assign()
        for k in range(len(centroids)):
            mine = [x for (_, x), (at, _) in zip(kept, members, strict=True) if at == k]
            if mine:
                centroids[k] = [sum(col) // len(mine) for col in zip(*mine, strict=True)]
    final = assign()
    digest = [hashlib.sha256(",".join(map(str, x)).encode()).hexdigest() for x in centroids]
    return sorted(
        [
            (i, k, d, sum(e for j, e in final if j == k), sum(e for _, e in final), digest[k])
            for (i, _), (k, d) in zip(kept, final, strict=True)
        ],
        key=repr,
    )


def vectors(seed, n, dimension, spread=1.0):
    rng = np.random.default_rng(seed)
    hubs = rng.normal(size=(7, dimension)) * spread
    return [(int(i), (hubs[i % 7] + rng.normal(size=dimension) * 0.3).tolist()) for i in range(n)]


def result(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


@pytest.mark.parametrize(
    "c, n",
    [
        (Clusters(count=9, dimension=6), 400),
        (Clusters(count=40, dimension=64, rounds=3), 300),
        (Clusters(count=5, dimension=2, scale=2), 200),  # many ties
        (Clusters(count=12, dimension=3, rounds=0), 50),
        (Clusters(count=12, dimension=3, pivots=2, pairs=1), 5),  # fewer vectors than centroids
    ],
)
def test_clusters_are_those_of_measuring_every_distance(spark, c, n):
    rows = vectors(n, n, c.dimension)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert result(cluster_vectors(df, c)) == plain(rows, c)


def test_no_bound_is_above_a_distance_and_most_distances_are_spared():
    rng = np.random.default_rng(3)
    for scale in (3, 1000, LARGEST // 2):
        x = rng.integers(-scale, scale, size=(500, 8))
        x[250:] = x[rng.integers(0, 250, 250)] // 2 + scale // 3
        centroids = x[rng.integers(0, 500, 30)]
        c = Clusters(count=30, dimension=8)
        pivots, pairs = choose_pivots(centroids, c)
        to_pivots = np.sqrt(squared(x, pivots).astype(float))
        exact = squared(x, centroids)
        assert (lower_bounds(to_pivots, centroids, pivots, pairs) <= exact).all()
        cluster, distance, _ = nearest(x, to_pivots, centroids, pivots, pairs)
        assert (cluster == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()
    hubs = rng.integers(-5000, 5000, size=(30, 8))
    x = hubs[rng.integers(0, 30, 2000)] + rng.integers(-40, 40, size=(2000, 8))
    pivots, pairs = choose_pivots(hubs, c)
    to_pivots = np.sqrt(squared(x, pivots).astype(float))
    _, _, measured = nearest(x, to_pivots, hubs, pivots, pairs)
    assert measured < 2000 * 30 / 5


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (1, [1.0, 2.0]), (1, [1.0, 2.0]), (1, [-3.5, 0.001]), (None, [1.0, 2.0]), (None, None), (2, []),
        (3, [1.0]), (4, [1.0, None]), (5, [inf, 1.0]), (6, [1.0, nan]), (7, [-inf, 1.0]), (8, [0.0, -0.0]),
        (9, [1.0, 2.0, 3.0]), (10, [4000.0, -4000.0]),
    ]
    c = Clusters(count=3, dimension=2)
    df = spark.createDataFrame(rows, SCHEMA).withColumns(
        {name: F.lit("k") for name in ("x", "cluster", "distance", "to_pivots", "inertia", "h", "components")}
    )
    assert result(cluster_vectors(df, c)) == plain(rows, c)
    assert cluster_vectors(df.limit(0), c).collect() == []
    same = spark.createDataFrame([(i, [1.0, 1.0]) for i in range(50)], SCHEMA)
    assert {tuple(r)[1:5] for r in cluster_vectors(same, c).collect()} == {(0, 0, 0, 0)}


def test_a_component_beyond_the_range_is_refused_by_name(spark):
    df = spark.createDataFrame([(1, [1e30, 0.0])], SCHEMA)
    with pytest.raises(Exception, match="component beyond"):
        whole_vectors(df, Clusters(dimension=2)).collect()


def test_sums_of_clusters_are_exact_and_rounded_down(spark):
    c = Clusters(count=2, dimension=2, scale=1)
    big = float(LARGEST - 1)
    rows = [(i, [big, -1.0 if i % 3 else -2.0]) for i in range(1000)] + [(5000, [-big, 0.0])]
    whole = whole_vectors(spark.createDataFrame(rows, SCHEMA).repartition(8), c)
    assert len(first_centroids(whole, c)) == 2
    start = np.array([[LARGEST - 1, 0], [-LARGEST, 0], [7, 7]])
    moved, _ = moved_centroids(
        whole.withColumn("to_pivots", F.array(F.lit(0.0))), start, pivots=start[:0], pairs=[]
    )
    # -1.333 rounds down to -2; an empty cluster stays.
    assert moved.tolist() == [[LARGEST - 1, -2], [-(LARGEST - 1), 0], [LARGEST, 7]][:2] + [[7, 7]]
