import random
import re

import pytest

from tallybook.llm import repeated_windows as rw

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_force(rows, window=13):
    """{doc_id: (n_words, n_removed, kept)} of rows with different ids."""
    holders = {}
    for i, text in rows:
        words = WORD.findall(text or "")
        for k in range(len(words) - window + 1):
            holders.setdefault(tuple(words[k : k + window]), set()).add(i)
    found = {}
    for i, text in rows:
        words = WORD.findall(text or "")
        gone = set()
        for k in range(len(words) - window + 1):
            if min(holders[tuple(words[k : k + window])]) < i:
                gone.update(range(k, k + window))
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        found[i] = (len(words), len(gone), kept)
    return found


def corpus(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(30)] + ["é", "W1", "😀", " "]
    passages = [rng.choices(words, k=k) for k in (12, 13, 14, 30, 60)]
    rows = []
    for i in range(60):
        text = []
        for _ in range(rng.randrange(6)):
            text += rng.choice(passages) if rng.random() < 0.4 else rng.choices(words, k=rng.randrange(30))
        rows.append((i - 20, rng.choice([" ", "\n", "\t "]).join(text)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("window", [2, 7, 13, 20])
def test_equals_brute_force(spark, window):
    rows = corpus(window)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = {
        r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_text"])
        for r in rw.remove_repeated_windows(docs, window).collect()
    }
    assert got == brute_force(rows, window)


def test_spans_name_the_removed_words(spark):
    rows = corpus(3)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    text = dict(rows)
    for r in rw.remove_repeated_windows(docs).collect():
        words = WORD.findall(text[r["doc_id"]])
        spans = list(zip(r["removed_spans"][::2], r["removed_spans"][1::2], strict=True))
        gone = {k for a, b in spans for k in range(a, b)}
        assert len(gone) == r["n_removed"] == sum(b - a for a, b in spans)
        assert " ".join(w for k, w in enumerate(words) if k not in gone) == r["kept_text"]


def test_odd_rows(odd):
    got = sorted(
        ((r["doc_id"], r["n_words"], r["n_removed"]) for r in rw.remove_repeated_windows(odd).collect()),
        key=str,
    )
    assert got == sorted(
        [(1, 16, 0), (2, 16, 16), (2, 16, 16), (3, 0, 0), (4, 0, 0), (5, 0, 0), (6, 1, 0),
         (None, 5, 0), (None, 0, 0), (7, 20_000, 0), (8, 4, 0)],
        key=str,
    )


def test_no_rows(no_rows):
    assert rw.remove_repeated_windows(no_rows).count() == 0


def test_levels_double():
    assert rw.level_lengths(13) == [7, 13]
    assert rw.level_lengths(50) == [7, 13, 25, 50]
    with pytest.raises(ValueError):
        rw.level_lengths(1)
