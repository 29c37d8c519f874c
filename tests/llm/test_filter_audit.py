"""The audit against filters that are applied document by document, and Shapley's own formula."""

import random
import re
from collections import Counter, defaultdict
from fractions import Fraction
from itertools import combinations, permutations
from math import factorial

import duckdb
import pytest
from pyspark.sql import functions as F

from tallybook.llm import oracles
from tallybook.llm.filter_audit import audit, audit_filters, failure_patterns, shapley_coefficients
from tests.compare import assert_same
from tests.llm.conftest import ODD


def random_docs(seed, n=300):
    rng = random.Random(seed)
    texts = [
        " ".join(rng.choice(["a", "B", "c#", "word", f"w{i % 400}", "XYZ"]) for i in range(rng.choice([0, 1, 150, 199, 200, 400])))
        for _ in range(40)
    ]
    ids = list(range(n))
    rng.shuffle(ids)
    return [(i, rng.choice([*texts, None, ""]), rng.choice(["x", "y", None, "", "only"])) for i in ids]


def fails(docs):
    first = {}
    for i, text, _ in docs:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    found = []
    for i, text, source in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        bad = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": i is not None and first[text] < i,
        }
        found.append((i, source or "", {k for k, v in bad.items() if v}))
    return found


def walked(docs, labels):
    """Every order, step by step."""
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    parts = defaultdict(list)
    for i, part, bad in fails(docs):
        parts[part].append((i, bad))
    rows, share = {}, Counter()
    for part, members in parts.items():
        for order in permutations("ABCDE"):
            left = members
            for step, letter in enumerate(order, 1):
                gone = [(i, b) for i, b in left if letter in b]
                before = len([1 for i, b in members if letter in b]) - len(gone)
                left = [(i, b) for i, b in left if letter not in b]
                share[part, letter] += len(gone)
                rows[part, "".join(order), step] = (
                    len(left), len(gone), before, sum(b == {letter} for _, b in members),
                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone),
                )
    return {k: (*v, share[k[0], k[1][k[2] - 1]]) for k, v in rows.items()}


def got(df):
    return {
        (r["part"], r["filter_order"], r["step"]): (
            r["kept"], r["removed"], r["redundant"], r["unique_fails"], r["good_lost"], r["toxic_lost"], r["shapley"],
        )
        for r in df.collect()
    }


LABELS = "doc_id bigint, quality int, toxic int"
DOCS = "doc_id bigint, text string, source string"


@pytest.mark.parametrize("seed", [1, 2])
def test_every_order_step_by_step(spark, seed):
    docs = random_docs(seed)
    rng = random.Random(seed)
    labels = [(rng.randrange(400), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(300)]
    df = spark.createDataFrame(docs, DOCS).repartition(4)
    marks = spark.createDataFrame(labels, LABELS)
    expected = walked(docs, labels)
    assert got(audit_filters(df, marks)) == expected and len(expected) == 4 * 600
    con = duckdb.connect()
    con.execute(f"CREATE TABLE documents ({DOCS}); CREATE TABLE labels ({LABELS})")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", docs)
    con.executemany("INSERT INTO labels VALUES (?, ?, ?)", labels)
    assert_same(audit_filters(df, marks).drop("filter"), con, oracles.FILTER_AUDIT)


@pytest.mark.parametrize("n", [2, 3, 5, 6])
def test_least_squares_give_the_shapley_value(n):
    rows = shapley_coefficients(n)
    for i in range(n):
        expected = [Fraction(0)] * (1 << n)
        others = [j for j in range(n) if j != i]
        for size in range(n):
            weight = Fraction(factorial(size) * factorial(n - size - 1), factorial(n))
            for coalition in combinations(others, size):
                mask = sum(1 << j for j in coalition)
                expected[mask] -= weight
                expected[mask | 1 << i] += weight
        assert rows[i][1:] == expected[1:]


def test_odd_rows(spark, odd, no_rows):
    labels = spark.createDataFrame([(2, 1, 1), (2, 0, 0), (None, 1, 1), (7, None, 1)], LABELS)
    docs = [(i, t, s) for i, t, s in ODD]
    clashing = odd.withColumns({c: F.lit(1) for c in ("part", "pattern", "docs", "words", "good", "toxic", "step")})
    assert got(audit_filters(clashing, labels)) == walked(docs, [(2, 1, 1), (7, None, 1)])
    assert audit_filters(no_rows, labels).collect() == []
    rows = got(audit_filters(odd, labels.limit(0)))
    assert {(v[4], v[5]) for v in rows.values()} == {(0, 0)}


def test_rows_that_repeat_are_no_copies_and_null_ids_are_neither(spark):
    docs = [(5, "t", "s"), (5, "t", "s"), (6, "t", "s"), (None, "t", "s"), (None, "t", "s"), (9, "u", "s")]
    df = spark.createDataFrame(docs, DOCS)
    labels = spark.createDataFrame([], LABELS)
    patterns = failure_patterns(df, labels, {"A": "false"}, repeat="E").collect()
    assert {(r["pattern"], r["docs"]) for r in patterns} == {(0, 5), (2, 1)}


def test_other_filters(spark):
    docs = [(i, "x" * i, "s") for i in range(20)]
    df, labels = spark.createDataFrame(docs, DOCS), spark.createDataFrame([], LABELS)
    filters = {"S": "length(text) < 5", "L": "length(text) > 15", "O": "length(text) % 2 = 1"}
    rows = got(audit(failure_patterns(df, labels, filters), list(filters)))
    assert len(rows) == 6 * 3
    assert {k[1]: v[:4] for k, v in rows.items() if k[2] == 3 and k[1] == "SLO"} == {"SLO": (5, 6, 4, 6)}
    assert rows["s", "OSL", 1][6] == 6 * 6 + 6 * 4 // 2  # half of what it shares with one other
    with pytest.raises(ValueError):
        audit(failure_patterns(df, labels, filters), ["AB", "C"])
