import itertools
import random

import numpy as np
import pytest

from tallybook.llm import jaccard_join as jj


def shingles(text, words=5):
    if text is None:
        return frozenset()
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    for c in "\t\n\x0b\x0c\r":
        lower = lower.replace(c, " ")
    found = [w for w in lower.split(" ") if w]
    if len(found) < words:
        return frozenset([tuple(found)]) if found else frozenset()
    return frozenset(tuple(found[i : i + words]) for i in range(len(found) - words + 1))


def brute_force(rows, percent=80):
    """{doc_id: (n_shingles, component_id)} by all pairs."""
    sets = {i: shingles(text) for i, text in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        both, either = len(sets[a] & sets[b]), len(sets[a] | sets[b])
        if both and 100 * both >= percent * either:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def corpus(seed):
    """Groups of copies with a few words changed, on a small vocabulary."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["The", "THE", "the", "É", "é"]
    rows = []
    for _ in range(25):
        base = rng.choices(words, k=rng.choice([1, 3, 5, 6, 30, 80, 200]))
        for _ in range(rng.choice([1, 2, 6, 20])):
            text = list(base)
            for _ in range(rng.randrange(4)):
                text[rng.randrange(len(text))] = rng.choice(words)
            rows.append(rng.choice([" ", "\n", "  "]).join(text))
    rng.shuffle(rows)
    return list(enumerate(rows))


def result(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


@pytest.mark.parametrize("settings", [{}, {"hub_rounds": 0}, {"pair_up_to": 3, "block": 4}])
def test_equals_all_pairs(spark, settings):
    rows = corpus(len(settings))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = result(jj.similar_components(docs, jj.Join(**settings)))
    assert got == brute_force(rows)


def test_odd_rows(odd):
    got = sorted(
        ((r["doc_id"], r["n_shingles"], r["component_id"]) for r in
         jj.similar_components(odd).collect()),
        key=str,
    )
    assert got == sorted(
        [(1, 12, 1), (2, 12, 1), (2, 12, 1), (3, 0, 3), (4, 0, 4), (5, 0, 5), (6, 1, 6),
         (None, 1, None), (None, 0, None), (7, 1, 7), (8, 1, 8)],
        key=str,
    )


def test_no_rows(no_rows):
    assert jj.similar_components(no_rows).count() == 0


def test_prefixes_keep_every_pair():
    """Two sets at the threshold share as many prefix tokens as the smaller l asks for."""
    rng = np.random.default_rng(1)
    join = jj.Join()
    for _ in range(300):
        n = int(rng.integers(5, 80))
        common = rng.choice(10_000, n, replace=False)
        drop = int(rng.integers(0, n // 9 + 1))
        other = np.concatenate([common[drop:], 20_000 + rng.integers(0, 10_000, drop)])
        both = len(np.intersect1d(common, other))
        if 100 * both < 80 * (len(common) + len(np.unique(other)) - both):
            continue
        levels = {t: 1 + int(t) % 7 for t in np.concatenate([common, other]).tolist()}
        sides = []
        for tokens in (common, np.unique(other)):
            order = sorted(tokens.tolist(), key=lambda t: (levels[t], t))
            ell, length = jj.prefix(
                np.array([levels[t] for t in order], dtype=np.uint8), len(order), join
            )
            sides.append((ell, set(order[:length])))
        assert len(sides[0][1] & sides[1][1]) >= min(sides[0][0], sides[1][0])


def test_bad_parameters():
    with pytest.raises(ValueError):
        jj.Join(percent=0)


def test_missing_column(odd):
    with pytest.raises(ValueError, match="text"):
        jj.similar_components(odd.drop("text"))
