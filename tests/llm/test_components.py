import random

from tallybook.llm.components import connected_components


def test_components_of_random_graphs_and_a_long_path(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(1000, 1200)]
    edges += [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]
    edges += [(5, 5), (None, 3), (3, None)]
    root = {}

    def find(i):
        root.setdefault(i, i)
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    got = [(r["node"], r["component"]) for r in connected_components(df).collect()]
    assert len(got) == len(dict(got))
    assert dict(got) == {i: find(i) for i in root}


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "a string, b string")).count() == 0
