import math
import zlib
from collections import Counter, defaultdict

import pytest

from tallybook.llm.entropy_mix import Mix, mix_sources, source_targets, source_tilts
from tallybook.llm.ring_shards import Ring, ring_arcs, ring_shards
from tests.llm.conftest import ODD


def numbered(spark, n, repeat=0):
    rows = [(i, f"text {i} " * (i % 7)) for i in range(n)] + [(-1, "hot")] * repeat
    return spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)


@pytest.mark.parametrize("n, repeat, shards", [(1000, 0, 16), (500, 300, 7), (3, 0, 16), (40, 0, 1)])
def test_counts_differ_by_one_at_most_and_slots_have_no_gaps(spark, n, repeat, shards):
    placed = ring_shards(numbered(spark, n, repeat), Ring(shards=shards)).collect()
    assert len(placed) == n + repeat
    slots = defaultdict(list)
    for r in placed:
        slots[r["shard"]].append(r["slot"])
    counts = [len(slots[s]) for s in range(shards)]
    assert max(counts) - min(counts) <= 1 and set(slots) <= set(range(shards))
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_rows_follow_the_ring(spark):
    """Against a walk row by row: arcs offer to their shard, then clockwise, in ring order."""
    ring = Ring(shards=5, points=4)
    docs = numbered(spark, 300)
    arcs = [r for r in ring_arcs(spark, ring).orderBy("stop").collect()]
    positions = {
        r["doc_id"]: r["p"]
        for r in docs.selectExpr(
            "doc_id", "shiftrightunsigned(xxhash64(doc_id, text), 32) AS p"
        ).collect()
    }
    points = [a for a in arcs if a["stop"] < 2**32]
    members = defaultdict(list)
    for doc, p in sorted(positions.items(), key=lambda x: (x[1], x[0])):
        members[next((a["arc"] for a in points if a["stop"] >= p), points[0]["arc"])].append(doc)
    room = [300 // 5] * 5
    expected, left = {}, {a["arc"]: members[a["arc"]] for a in points}
    for turn in range(5):
        for i, a in enumerate(points):
            met = list(dict.fromkeys(points[(i + k) % len(points)]["shard"] for k in range(len(points))))
            shard = met[turn]
            taken = left[a["arc"]][: room[shard]]
            left[a["arc"]] = left[a["arc"]][len(taken) :]
            room[shard] -= len(taken)
            expected |= dict.fromkeys(taken, shard)
    assert {r["doc_id"]: r["shard"] for r in ring_shards(docs, ring).collect()} == expected


def test_few_rows_move_to_one_more_shard(spark):
    docs = numbered(spark, 2000)
    before = {r["doc_id"]: r["shard"] for r in ring_shards(docs, Ring(shards=16)).collect()}
    after = {r["doc_id"]: r["shard"] for r in ring_shards(docs, Ring(shards=17)).collect()}
    moved = sum(before[i] != after[i] for i in before)
    assert moved < 0.2 * len(before)


def test_slack_lets_more_rows_stay_at_home(spark):
    docs = numbered(spark, 600)
    loads = Counter(r["shard"] for r in ring_shards(docs, Ring(shards=8, slack=0.25)).collect())
    assert sum(loads.values()) == 600 and max(loads.values()) <= math.ceil(1.25 * 600 / 8)


def test_odd_rows_have_shards(odd, no_rows):
    got = ring_shards(odd, Ring()).collect()
    assert len(got) == len(ODD)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in ODD
    )
    assert ring_shards(no_rows, Ring()).count() == 0


def water_level(sizes, weights=(1, 2, 3), most=3):
    """Targets by sharing the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, target, full = sum(sizes.values()), {}, set()
    while True:
        free = [s for s in names if s not in full]
        rest = total - sum(most * sizes[s] for s in full)
        share = sum(weight[s] for s in free)
        target = {s: float(most * sizes[s]) for s in full}
        target |= {s: rest * weight[s] / share for s in free}
        above = {s for s in free if target[s] > most * sizes[s] * (1 + 1e-12)}
        if not above:
            return target
        full |= above


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 100, "b": 100, "c": 100},
        {"a": 1000, "b": 10, "c": 10, "d": 400, None: 5},
        {"Z": 1, "a": 1, "é": 100_000, "😀": 3},
        {"only": 7},
        {"a": 0, "b": 10},
    ],
)
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, size bigint")
    got = {r["source"]: r["target"] for r in source_targets(df, Mix()).collect()}
    assert got == pytest.approx(water_level(sizes))


def test_mix_meets_targets_and_reruns_agree(spark):
    rows = [
        (i, " ".join(["w"] * (1 + i * i % 90)), f"s{i % 5}" if i % 11 else None) for i in range(800)
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    first, again = (
        {r["doc_id"]: r for r in mix_sources(docs.repartition(n)).collect()} for n in (2, 5)
    )
    assert {i: r["copies"] for i, r in first.items()} == {i: r["copies"] for i, r in again.items()}
    sizes, taken, target = Counter(), Counter(), {}
    for i, text, source in rows:
        r = first[i]
        assert r["size"] == len(text.split()) and r["taken"] == r["copies"] * r["size"]
        assert 0 <= r["copies"] <= 3
        sizes[source] += r["size"]
        taken[source] += r["taken"]
        target[source] = r["target"]
    assert target == pytest.approx(water_level(sizes))
    for source in sizes:
        assert abs(taken[source] - target[source]) <= 90


def test_a_source_at_its_limit_is_taken_fully(spark):
    rows = [(i, "w " * 50, "big") for i in range(200)] + [(1000 + i, "w " * 9, "tiny") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    copies = {r["doc_id"]: r["copies"] for r in mix_sources(docs).collect()}
    assert {copies[1000 + i] for i in range(3)} == {3}


def test_odd_rows_are_mixed(odd, no_rows):
    got = mix_sources(odd)
    assert got.columns == ["doc_id", "text", "source", "lang", "score", "key", "size",
                           "source_size", "target", "copies", "taken"]
    rows = got.collect()
    assert len(rows) == len(ODD) and all(r["copies"] <= 3 for r in rows)
    assert {r["copies"] for r in rows if r["size"] == 0} == {1}
    assert mix_sources(no_rows).count() == 0


def words_taken(docs, tilt, most=3):
    rates = {size: most / (1 + (most - 1) * math.exp(min(-tilt * size, 700))) for size in docs}
    return sum(n * size * rates[size] for size, n in docs.items())


@pytest.mark.parametrize("share", [0.05, 0.3, 0.5, 0.9, 1.0, 1.1, 2.0])
def test_tilts_against_bisection_of_the_dual(spark, share):
    """Sources of many shapes, most of them with a target below their size."""
    sources = {
        "even": {7: 40},
        "two": {3: 50, 80: 9},
        "many": {1 + i * i % 97: 1 + i % 5 for i in range(60)},
        "wide": {int(math.exp(i / 4)): 200 // (i + 1) for i in range(4, 40)},
        None: {1: 3, 2: 2, 5: 1},
    }
    counts = [(name, size, n) for name, docs in sources.items() for size, n in docs.items()]
    sizes = {name: sum(size * n for size, n in docs.items()) for name, docs in sources.items()}
    targets = [(name, size, share * size) for name, size in sizes.items()]
    got = source_tilts(
        spark.createDataFrame(counts, "source string, size bigint, docs bigint"),
        spark.createDataFrame(targets, "source string, source_size bigint, target double"),
        Mix(),
    ).collect()
    assert len(got) == len(sources)
    for r in got:
        docs, low, high = sources[r["source"]], -60.0, 60.0
        for _ in range(200):
            middle = (low + high) / 2
            low, high = (middle, high) if words_taken(docs, middle) < r["target"] else (low, middle)
        assert r["tilt"] == pytest.approx(low, rel=1e-6, abs=1e-9)
        assert words_taken(docs, r["tilt"]) == pytest.approx(r["target"], rel=1e-6)
