"""Removing passages that an earlier document holds already, found level by level.

A window of 13 words can only repeat if its halves do. The first level looks at windows of 7
words alone, of each 13 the one with the smallest hash, so that equal windows choose the same
half. Only where that half repeats in the corpus is the window extended to its double, and
only those are compared at full length. Levels go on doubling while windows survive, up to the
length that is asked for.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.chunks import (
    ANSWERED,
    ASKED,
    Words,
    answered,
    asked,
    bits_in_order,
    chunk_count,
    chunk_of,
    combined,
    slices,
)
from tallybook.llm.shared import of_cogroup, of_group, require_columns

#: What a document without an id counts as: larger than all.
NO_ID = np.iinfo(np.int64).max


def level_lengths(window: int) -> list[int]:
    """Lengths of the levels: halves, rounded up, down to 7 words or less."""
    if window < 2:
        raise ValueError(f"a window of {window} words")
    lengths = [window]
    while lengths[0] > 7:
        lengths.insert(0, (lengths[0] + 1) // 2)
    return lengths


def _smallest(hashes: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` consecutive hashes."""
    n = len(hashes) - width + 1
    found = hashes[: max(n, 0)].copy()
    for i in range(1, width):
        np.minimum(found, hashes[i : i + n], out=found)
    return found


def _levels(words: Words, lengths: list[int]) -> tuple[list[np.ndarray], np.ndarray]:
    """For every window of the last length, its hash at each level, and which are whole."""
    window = lengths[-1]
    full, whole = words.grams(window)
    levels = []
    for length in lengths[:-1]:
        part, _ = words.grams(length)
        levels.append(_smallest(part, window - length + 1) if len(full) else full)
    return [*levels, full], whole


def _surviving(
    docs: pa.Table, replies: pa.Table | None, lengths: list[int], buckets: int, upto: int
) -> tuple[np.ndarray, np.ndarray, list]:
    """Sorted different hashes of level ``upto`` among windows that all earlier levels kept.

    With each the smallest id that holds it; and, by slice, the words and the windows' hashes
    and ids, for another look.
    """
    text, ids = combined(docs["text"]), combined(docs["id"]).to_numpy()
    parts = []
    for a, b in slices(text):
        words = Words(text[a:b])
        levels, whole = _levels(words, lengths)
        at = np.flatnonzero(whole)
        of = ids[a:b][np.searchsorted(words.first, at, side="right") - 1]
        parts.append((words, [level[at] for level in levels], at, of, (a, b)))
    hashes, least = np.empty(0, np.uint64), np.empty(0, np.int64)
    for level in range(upto + 1):
        h = np.concatenate([p[1][level] for p in parts]) if parts else hashes
        of = np.concatenate([p[3] for p in parts]) if parts else least
        order = np.lexsort((of, h))
        h, of = h[order], of[order]
        new = np.ones(len(h), dtype=bool)
        new[1:] = h[1:] != h[:-1]
        last = np.flatnonzero(np.append(new[1:], True)) if len(h) else np.empty(0, np.int64)
        hashes, least, most = h[new], of[new], of[last]
        if level < upto:
            kept = bits_in_order(replies, level, hashes, buckets) | (least != most)
            parts = [
                (words, [x[keep] for x in levels], at[keep], doc[keep], rows)
                for words, levels, at, doc, rows in parts
                for keep in [kept[np.searchsorted(hashes, levels[level])]]
            ]
    return hashes, least, parts


def _ask(
    key, docs: pa.Table, replies: pa.Table | None = None, *, lengths: list[int], buckets: int, level: int
) -> pa.Table:
    hashes, least, _ = _surviving(docs, replies, lengths, buckets, level)
    if level < len(lengths) - 1:
        # Whether another chunk has the hash, too, needs no more than its low half.
        low = hashes.astype(np.uint32)
        return asked(key[0].as_py(), hashes, buckets, lambda a, b: low[a:b].tobytes())
    return asked(
        key[0].as_py(),
        hashes,
        buckets,
        lambda a, b: hashes[a:b].tobytes() + least[a:b].tobytes(),
    )


def _answer(key, table: pa.Table, level: int, last: bool) -> pa.Table:
    """A bit for each hash of each chunk.

    Before the last level: does another chunk have it? At the last: does another chunk have it
    in a document with a smaller id than any of this chunk's?
    """
    del key
    blobs = table["data"].to_pylist()
    if last:
        sizes = [len(blob) // 16 for blob in blobs]
        hashes = np.concatenate([np.frombuffer(b, np.uint64, n) for b, n in zip(blobs, sizes)])
        least = np.concatenate([np.frombuffer(b, np.int64, n, 8 * n) for b, n in zip(blobs, sizes)])
        order = np.lexsort((least, hashes))
        new = np.ones(len(hashes), dtype=bool)
        new[1:] = hashes[order][1:] != hashes[order][:-1]
        smallest = least[order][new][np.cumsum(new) - 1]
        bits = np.empty(len(hashes), dtype=bool)
        bits[order] = smallest < least[order]
    else:
        sizes = [len(blob) // 4 for blob in blobs]
        hashes = np.concatenate([np.frombuffer(b, np.uint32, n) for b, n in zip(blobs, sizes)])
        order = np.argsort(hashes, kind="stable")
        same = hashes[order][1:] == hashes[order][:-1]
        bits = np.empty(len(hashes), dtype=bool)
        bits[order] = np.append(same, False) | np.insert(same, 0, False)
    ends = np.cumsum(sizes)
    return answered(
        level,
        table,
        [np.packbits(bits[e - n : e]).tobytes() for e, n in zip(ends, sizes, strict=True)],
    )


def _remove(key, docs: pa.Table, replies: pa.Table, lengths: list[int], buckets: int) -> pa.Table:
    last = len(lengths) - 1
    hashes, least, parts = _surviving(docs, replies, lengths, buckets, last)
    elsewhere = bits_in_order(replies, last, hashes, buckets)
    kept_texts, n_words, n_removed, spans = [], [], [], []
    for words, levels, at, of, _ in parts:
        found = np.searchsorted(hashes, levels[last])
        repeated = at[elsewhere[found] | (least[found] < of)]
        cover = np.zeros(len(words.start) + 1, dtype=np.int64)
        np.add.at(cover, repeated, 1)
        np.add.at(cover, repeated + lengths[-1], -1)
        removed = np.cumsum(cover[:-1]) > 0
        kept_texts.append(_kept_text(words, ~removed))
        total = np.insert(np.cumsum(removed), 0, 0)
        n_words.append(np.diff(words.first))
        n_removed.append(total[words.first[1:]] - total[words.first[:-1]])
        spans += _spans(words, removed)
    del key
    return pa.table(
        {
            "doc_id": combined(docs["doc_id"]),
            "n_words": pa.array(np.concatenate(n_words) if n_words else [], pa.int64()),
            "n_removed": pa.array(np.concatenate(n_removed) if n_removed else [], pa.int64()),
            "kept_text": pa.concat_arrays(kept_texts) if kept_texts else pa.array([], pa.string()),
            "removed_spans": pa.array(spans, pa.list_(pa.int64())),
        }
    )


def _kept_text(words: Words, kept: np.ndarray) -> pa.Array:
    """The kept words of every text, joined by one space."""
    n = len(words.data)
    index = np.flatnonzero(kept)
    step = np.zeros(n + 1, dtype=np.int8)
    step[words.start[index]] += 1
    step[words.end[index]] -= 1
    mask = np.cumsum(step[:-1], dtype=np.int8) > 0
    of = np.searchsorted(words.first, index, side="right") - 1
    # After each kept word but a text's last there is white space before the next word.
    gaps = words.end[index[:-1][of[1:] == of[:-1]]]
    body = words.data.copy()
    body[gaps] = 0x20
    mask[gaps] = True
    total = np.insert(np.cumsum(mask), 0, 0)
    return pa.LargeStringArray.from_buffers(
        len(words), pa.py_buffer(total[words.at].astype(np.int64)), pa.py_buffer(body[mask])
    ).cast(pa.string())


def _spans(words: Words, removed: np.ndarray) -> list[list[int]]:
    """Of every text the removed ranges of words, as start, end, start, end ..."""
    found: list[list[int]] = [[] for _ in range(len(words))]
    if not removed.any():
        return found
    edge = np.zeros(len(removed) + 1, dtype=bool)
    edge[words.first] = True
    turn = np.flatnonzero(removed & (edge[:-1] | np.insert(~removed[:-1], 0, True)))
    stop = np.flatnonzero(removed & (edge[1:] | np.append(~removed[1:], True))) + 1
    of = np.searchsorted(words.first, turn, side="right") - 1
    for d, a, b in zip(of.tolist(), turn.tolist(), stop.tolist(), strict=True):
        found[d] += [a - int(words.first[d]), b - int(words.first[d])]
    return found


def remove_repeated_windows(docs: DataFrame, window: int = 13) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text, removed_spans) of every document.

    A word is removed if a window of ``window`` words covers it that also starts in a document
    with a smaller id. Words are separated by ASCII white space and compared unchanged; windows
    are judged on the input. ``removed_spans`` has word indexes: start, end, start, end ...
    A null or empty text has no words. Ids are whole numbers; a null id counts as larger than
    all, and rows with equal ids do not remove from each other. An empty table gives no rows;
    other columns are ignored.
    """
    require_columns(docs, "doc_id", "text")
    lengths = level_lengths(window)
    count = chunk_count(docs)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    dealt = docs.select(
        "doc_id",
        F.coalesce(F.col("doc_id").cast("long"), F.lit(int(NO_ID))).alias("id"),
        "text",
        chunk_of(count, F.col("doc_id"), F.col("text")).alias("chunk"),
    )
    given = {"lengths": lengths, "buckets": count}
    replies = None
    for level in range(len(lengths)):
        grouped = dealt.groupBy("chunk")
        if replies is None:
            questions = grouped.applyInArrow(of_group(_ask, level=level, **given), ASKED)
        else:
            questions = grouped.cogroup(replies.groupBy("chunk")).applyInArrow(
                of_cogroup(_ask, level=level, **given), ASKED
            )
        new = questions.groupBy("bucket").applyInArrow(
            of_group(_answer, level=level, last=level == len(lengths) - 1), ANSWERED
        )
        replies = new if replies is None else replies.unionByName(new)
    return (
        dealt.groupBy("chunk")
        .cogroup(replies.groupBy("chunk"))
        .applyInArrow(
            of_cogroup(_remove, **given),
            f"doc_id {id_type}, n_words bigint, n_removed bigint, kept_text string, "
            "removed_spans array<bigint>",
        )
    )
