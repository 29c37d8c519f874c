import itertools

import numpy as np
import pytest

from tallybook.llm import near_vectors as nv


def unit(x):
    return x / np.linalg.norm(x)


def corpus(seed, dimension=64, groups=12, size=8):
    """Groups of vectors around a base at about the threshold, in three labels."""
    rng = np.random.default_rng(seed)
    rows = []
    for group in range(groups):
        base = unit(rng.normal(size=dimension))
        for _ in range(size):
            noise = unit(rng.normal(size=dimension)) * rng.uniform(0, 0.3)
            x = (base + noise).astype(np.float32) * np.float32(rng.uniform(0.1, 5))
            rows.append((len(rows), x.tolist(), group % 3))
    rows += [(len(rows) + i, rows[0][1], 0) for i in range(5)]
    return rows


def brute_force(rows, cosine=0.98):
    links, root = dict.fromkeys((r[0] for r in rows), 0), {r[0]: r[0] for r in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for (i, x, a), (j, y, b) in itertools.combinations(rows, 2):
        x, y = np.array(x, float), np.array(y, float)
        if a == b and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= cosine:
            links[i] += 1
            links[j] += 1
            p, q = find(i), find(j)
            root[max(p, q)] = min(p, q)
    return {i: (links[i], find(i), find(i) == i) for i in root}


@pytest.mark.parametrize("settings", [{}, {"pair_up_to": 3, "block": 4}, {"axes": 1, "tables": 6}])
def test_finds_all_links_and_no_other(spark, settings):
    rows = corpus(len(settings))
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").repartition(3)
    got = nv.link_vectors(df, nv.Buckets(**settings)).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got} == brute_force(rows)


def test_odd_rows(spark):
    x, inf, nan = [1.0, 2.0, 3.0], float("inf"), float("nan")
    rows = [
        (1, x, "a", 1), (2, [2.0, 4.0, 6.0], "a", 1), (2, x, "a", 1), (3, x, "b", 1), (4, x, None, 1),
        (5, None, "a", 1), (6, [], "a", 1), (7, [0.0, 0.0, 0.0], "a", 1), (8, [1.0, None, 3.0], "a", 1),
        (9, [1.0, inf, 3.0], "a", 1), (10, [1.0, nan, 3.0], "a", 1), (11, [1.0, 2.0], "a", 1),
        (None, x, "a", 1), (None, None, None, None), (12, [1e-300, 0.0, 0.0], "c", 1),
        (13, [1e300, 1e300, 0.0], "c", 1), (14, [5.0, 0.0, 0.0], "c", 1),
    ]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label string, node int")
    got = sorted(map(tuple, nv.link_vectors(df).collect()), key=str)
    assert got == sorted(
        [(1, 3, 1, True), (2, 3, 1, False), (2, 3, 1, False), (None, 3, 1, False), (3, 0, 3, True),
         (4, 0, 4, True), (5, 0, 5, True), (6, 0, 6, True), (7, 0, 7, True), (8, 0, 8, True),
         (9, 0, 9, True), (10, 0, 10, True), (11, 0, 11, True), (None, 0, None, True),
         (12, 1, 12, True), (14, 1, 12, False), (13, 0, 13, True)],
        key=str,
    )
    assert nv.link_vectors(df.limit(0)).count() == 0


def test_transform_is_a_rotation():
    x = np.random.default_rng(0).normal(size=(20, 32))
    y = nv.hadamard(x)
    assert np.allclose(y @ y.T, x @ x.T)
    assert np.allclose(nv.hadamard(y), x)


def test_buckets_depend_on_direction_alone():
    x = np.random.default_rng(0).normal(size=(50, 30))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    found = nv.codes(x, nv.Buckets())
    assert (found == nv.codes(x[::-1], nv.Buckets())[::-1]).all()
    # Probes of a vector are all different, and not its own bucket.
    assert all(len(set(row)) == found.shape[2] for row in found[:, 0].tolist())
