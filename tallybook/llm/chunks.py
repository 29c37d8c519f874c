"""Asking the whole corpus about hashes, chunk by chunk.

Documents are dealt into chunks of a bounded size by a hash. A chunk lists its different
hashes once, however many of its documents hold them, and sends them packed to buckets by hash
range. A bucket sees every chunk's entry of a hash and sends back a byte or a bit for each, in
the order in which they came. Chunks sort their hashes, so both sides agree on the order and no
position travels. A passage that a third of all documents share is one entry of each chunk.

Texts are shuffled once; later passes read the same shuffle files.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of text of a chunk, and the number of chunks that even a small table has.
CHUNK_BYTES = 8 << 20
LEAST_CHUNKS = 64
#: Bytes that are hashed together; a longer document is hashed alone.
SLICE_BYTES = 1 << 20

ASKED = "bucket int, chunk int, data binary"
ANSWERED = "chunk int, kind int, bucket int, data binary"

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_UNBASE = pow(_BASE, -1, 1 << 64)
_rng = np.random.default_rng(20240607)
#: A random number for each byte value; white space of ASCII parts words.
BYTE_VALUE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_lower = np.arange(256)
_lower[65:91] += 32
BYTE_VALUE_LOWER = BYTE_VALUE[_lower]
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """The finishing steps of a 64-bit hash."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """The words of some texts: where they stand in the bytes, and their 64-bit hashes.

    ``first[d]`` is the index of the first word of text d. A hash is that of a polynomial over
    the word's bytes, taken from running sums over all bytes.
    """

    def __init__(self, texts: pa.Array, lower: bool = False, hashes: bool = True) -> None:
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        at = np.frombuffer(texts.buffers()[1], dtype=np.int64)[
            texts.offset : texts.offset + len(texts) + 1
        ]
        body = texts.buffers()[2]
        self.data = (
            np.frombuffer(body, dtype=np.uint8)[at[0] : at[-1]]
            if body is not None and at[-1] > at[0]
            else np.empty(0, dtype=np.uint8)
        )
        self.at = at - at[0]
        n = len(self.data)
        ink = ~IS_SPACE[self.data]
        edge = np.zeros(n + 1, dtype=bool)
        edge[self.at] = True
        before = np.empty(n, dtype=bool)
        before[:1] = True
        before[1:] = ~ink[:-1]
        before |= edge[:-1]
        self.start = np.flatnonzero(ink & before)
        after = np.empty(n, dtype=bool)
        after[-1:] = True
        after[:-1] = ~ink[1:]
        after |= edge[1:]
        self.end = np.flatnonzero(ink & after) + 1
        self.first = np.searchsorted(self.start, self.at)
        if hashes:
            self.hash = self._hashes(BYTE_VALUE_LOWER if lower else BYTE_VALUE)

    def _hashes(self, values: np.ndarray) -> np.ndarray:
        n = len(self.data)
        powers = np.full(n, _BASE, dtype=np.uint64)
        powers[:1] = 1
        np.multiply.accumulate(powers, out=powers)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(values[self.data] * powers, out=sums[1:])
        back = np.full(n, _UNBASE, dtype=np.uint64)
        back[:1] = 1
        np.multiply.accumulate(back, out=back)
        found = (sums[self.end] - sums[self.start]) * back[self.start]
        return mixed(found + (self.end - self.start).astype(np.uint64))

    def __len__(self) -> int:
        return len(self.at) - 1

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of k consecutive words from each word on, and which of them end in the text."""
        n = len(self.start)
        if n < k:
            return np.empty(0, dtype=np.uint64), np.empty(0, dtype=bool)
        found = np.zeros(n - k + 1, dtype=np.uint64)
        for i in range(k):
            found = found * np.uint64(_BASE) + self.hash[i : n - k + 1 + i]
        whole = np.ones(n - k + 1, dtype=bool)
        for d in range(1, k):
            inside = self.first[:-1] - d
            whole[inside[(inside >= 0) & (inside <= n - k)]] = False
            inside = self.first[1:] - d
            whole[inside[(inside >= 0) & (inside <= n - k)]] = False
        return mixed(found), whole


def slices(texts: pa.ChunkedArray | pa.Array) -> list[tuple[int, int]]:
    """Ranges of rows with about SLICE_BYTES of text each."""
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy()
    turns = np.cumsum(lengths) // SLICE_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(turns)) + 1).tolist(), len(lengths)]
    return [(a, b) for a, b in zip(cuts, cuts[1:], strict=False) if b > a]


def combined(column: pa.ChunkedArray) -> pa.Array:
    array = column.combine_chunks()
    return pa.concat_arrays(array.chunks) if isinstance(array, pa.ChunkedArray) else array


def chunk_count(docs: DataFrame, text: str = "text") -> int:
    """How many chunks the table needs: one number from one pass over the text lengths."""
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(LEAST_CHUNKS, -(-total // CHUNK_BYTES))


def chunk_of(count: int, *key: Column | str) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(count)).cast("int")


def bucket_edges(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins in sorted hashes; buckets are equal ranges of the high half."""
    starts = (np.arange(buckets + 1, dtype=np.float64) * (2.0**64 / buckets)).tolist()
    bounds = np.array([min(int(x), _MASK) for x in starts], dtype=np.uint64)
    edges = np.searchsorted(hashes, bounds)
    edges[-1] = len(hashes)
    return edges


def asked(chunk: int, hashes: np.ndarray, buckets: int, pack) -> pa.Table:
    """A row for every bucket that sorted hashes fall into; pack(a, b) gives the bytes."""
    edges = bucket_edges(hashes, buckets)
    rows = [(i, pack(a, b)) for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False)) if b > a]
    return pa.table(
        {
            "bucket": pa.array([i for i, _ in rows], pa.int32()),
            "chunk": pa.array([chunk] * len(rows), pa.int32()),
            "data": pa.array([data for _, data in rows], pa.binary()),
        }
    )


def answered(kind: int, table: pa.Table, answers: list[bytes]) -> pa.Table:
    return pa.table(
        {
            "chunk": combined(table["chunk"]),
            "kind": pa.array([kind] * len(answers), pa.int32()),
            "bucket": combined(table["bucket"]),
            "data": pa.array(answers, pa.binary()),
        }
    )


def answers_in_order(replies: pa.Table, kind: int) -> list[bytes]:
    """A chunk's answers of one kind, bucket after bucket."""
    rows = replies.filter(pc.equal(replies["kind"], kind)).sort_by("bucket")
    return rows["data"].to_pylist()


def bits_in_order(replies: pa.Table, kind: int, hashes: np.ndarray, buckets: int) -> np.ndarray:
    """A chunk's answers of one bit for each hash."""
    edges = bucket_edges(hashes, buckets)
    sizes = [b - a for a, b in zip(edges, edges[1:], strict=False) if b > a]
    parts = [
        np.unpackbits(np.frombuffer(data, dtype=np.uint8), count=size)
        for data, size in zip(answers_in_order(replies, kind), sizes, strict=True)
    ]
    return np.concatenate(parts).astype(bool) if parts else np.empty(0, dtype=bool)
