"""Near copies among vectors by cross-polytope hashing.

A vector is rotated at random and hashed to the axis, with its sign, that it then lies closest
to. The rotation is three rounds of random signs and a fast Hadamard transform. Several such
axes make the bucket of a table; there are several tables, and from each bucket the next best
ones are probed, too. Vectors that meet in a bucket are compared exactly. A large bucket is cut
into blocks, compared two by two in different tasks, and what leaves a task are counts of links
and links that connect its vectors, not all pairs.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.chunks import combined, mixed
from tallybook.llm.components import connected_components
from tallybook.llm.shared import checkpointed, of_group, per_batch, require_columns


#: Rows of small buckets that are compared in one call, about.
CELL_ROWS = 16384


@dataclass(frozen=True)
class Buckets:
    """tables: their number. axes: hashes that make a bucket. probes: further buckets probed.

    pair_up_to: a larger bucket is compared in blocks of about ``block``.

    With 2 * dimension choices for an axis, ``axes`` should be about log(rows) /
    log(2 * dimension), so that a bucket has few vectors by chance: 2 for some ten thousand
    rows of 64 components, 3 for a million, 5 for ten thousand millions; more axes need more
    tables. Vectors at the threshold of 0.98 agree on an axis in about 0.8 of all rotations.
    """

    cosine: float = 0.98
    tables: int = 16
    axes: int = 3
    probes: int = 4
    pair_up_to: int = 64
    block: int = 512
    seed: int = 7


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of every row; the width is a power of two."""
    rows, width = x.shape
    step = 1
    while step < width:
        x = x.reshape(rows, width // (2 * step), 2, step)
        x = np.stack((x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]), axis=2)
        step *= 2
    return x.reshape(rows, width) / np.sqrt(width)


def codes(vectors: np.ndarray, buckets: Buckets) -> np.ndarray:
    """(row, table, 1 + probes): the bucket of each unit vector, then the ones to probe."""
    rows, dimension = vectors.shape
    width = max(2, 1 << (dimension - 1).bit_length())
    rng = np.random.default_rng([buckets.seed, width])
    padded = np.zeros((rows, width))
    padded[:, :dimension] = vectors
    found = np.zeros((rows, buckets.tables, 1 + buckets.probes), dtype=np.uint64)
    take = 1 + buckets.probes
    for table in range(buckets.tables):
        axis = np.zeros((rows, buckets.axes, take), dtype=np.int64)
        loss = np.zeros((rows, buckets.axes, take))
        for i in range(buckets.axes):
            x = padded
            for _ in range(3):
                x = hadamard(x * rng.choice((-1.0, 1.0), width))
            both = np.concatenate((x, -x), axis=1)
            best = np.argsort(-both, axis=1, kind="stable")[:, :take]
            best = np.pad(best, ((0, 0), (0, take - best.shape[1])), mode="edge")
            height = np.take_along_axis(both, best, axis=1)
            axis[:, i], loss[:, i] = best, (height[:, :1] - height) ** 2
        found[:, table, 0] = _code(axis[:, :, 0], table, width)
        # Probe where one axis gives way to its next best, the smallest losses first.
        others = [(i, j) for i in range(buckets.axes) for j in range(1, take)]
        order = np.argsort(np.stack([loss[:, i, j] for i, j in others]), axis=0, kind="stable")
        probed = []
        for i, j in others:
            moved = axis[:, :, 0].copy()
            moved[:, i] = axis[:, i, j]
            probed.append(_code(moved, table, width))
        probed = np.stack(probed)
        for k in range(buckets.probes):
            found[:, table, 1 + k] = np.take_along_axis(probed, order[k : k + 1], axis=0)[0]
    return found


def _code(axes: np.ndarray, table: int, width: int) -> np.ndarray:
    value = np.full(len(axes), table, dtype=np.uint64)
    for i in range(axes.shape[1]):
        value = value * np.uint64(2 * width) + axes[:, i].astype(np.uint64)
    return value


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled first, so that squares neither overflow nor vanish."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _hash_batch(batch: pa.RecordBatch, buckets: Buckets) -> pa.RecordBatch:
    """The vectors with their buckets, and short forms of these to tell pairs apart by."""
    lists = batch.column("embedding")
    lengths = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    starts = np.insert(np.cumsum(lengths), 0, 0)
    each = buckets.tables * (1 + buckets.probes)
    found = np.empty((len(lengths), each), dtype=np.uint64)
    for dimension in np.unique(lengths):
        at = np.flatnonzero(lengths == dimension)
        x = _unit(flat[starts[at][:, None] + np.arange(dimension)])
        # Vectors of another dimension never share a bucket.
        apart = mixed(np.array([dimension], dtype=np.uint64))
        found[at] = mixed(codes(x, buckets).reshape(len(at), each) + apart)
    short = found.astype(np.uint32)
    return pa.RecordBatch.from_arrays(
        [
            batch.column("node"),
            batch.column("label"),
            batch.column("copies"),
            lists,
            pa.ListArray.from_arrays(
                np.arange(len(lengths) + 1, dtype=np.int32) * each,
                pa.array(found.reshape(-1).view(np.int64)),
            ),
            pa.array([row.tobytes() for row in short], pa.binary()),
        ],
        names=["node", "label", "copies", "embedding", "buckets", "short"],
    )


class _Rows:
    """Vectors in their buckets, as arrays."""

    def __init__(self, table: pa.Table, buckets: Buckets) -> None:
        self.node = combined(table["node"]).to_numpy()
        self.copies = combined(table["copies"]).to_numpy()
        self.main = combined(table["main"]).to_numpy(zero_copy_only=False)
        self.table = combined(table["table"]).to_numpy()
        lists = combined(table["embedding"])
        lengths = np.diff(lists.offsets.to_numpy())
        flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        # Shorter vectors are never in a bucket with longer ones: what is added is not compared.
        x = np.zeros((len(lengths), lengths.max(initial=1)))
        x[np.arange(x.shape[1]) < lengths[:, None]] = flat
        self.unit = _unit(x)
        short = np.frombuffer(b"".join(table["short"].to_pylist()), np.uint32)
        self.short = short.reshape(len(lengths), buckets.tables, 1 + buckets.probes)

    def first_meeting(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether pairs of one bucket meet here, and in no table or bucket before."""
        kept = np.zeros(len(i), dtype=bool)
        for start in range(0, len(i), 65536):
            part = slice(start, start + 65536)
            kept[part] = self._first_meeting(i[part], j[part])
        return kept

    def _first_meeting(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        a, b, table = self.short[i], self.short[j], self.table[i]
        same = a[:, :, 0] == b[:, :, 0]
        a_probes = (a[:, :, 1:] == b[:, :, :1]).any(axis=2)
        b_probes = (b[:, :, 1:] == a[:, :, :1]).any(axis=2)
        first = np.argmax(same | a_probes | b_probes, axis=1) == table
        at = np.arange(len(i))
        a_main, b_main = self.main[i], self.main[j]
        # In one table: where both live; else in b's bucket, if a probes it; else in a's.
        here = np.where(
            same[at, table],
            a_main & b_main,
            np.where(a_probes[at, table], b_main & ~a_main, a_main & ~b_main),
        )
        return first & here

    def report(self, i: np.ndarray, j: np.ndarray) -> pa.Table:
        """Of linked pairs: the links of each vector with copies, and one that connects it."""
        links = np.zeros(len(self.node), dtype=np.int64)
        np.add.at(links, i, self.copies[j])
        np.add.at(links, j, self.copies[i])
        label = np.arange(len(self.node))
        while len(i):
            old = label.copy()
            np.minimum.at(label, i, label[j])
            np.minimum.at(label, j, label[i])
            if (label == old).all():
                break
        some = np.flatnonzero(links)
        return pa.table(
            {
                "node": pa.array(self.node[some], pa.int64()),
                "other": pa.array(self.node[label[some]], pa.int64()),
                "links": pa.array(links[some], pa.int64()),
            }
        )


def _compare_cell(key, table: pa.Table, *, buckets: Buckets) -> pa.Table:
    """Links inside many small buckets."""
    del key
    table = table.sort_by([("label", "ascending"), ("bucket", "ascending"), ("node", "ascending")])
    rows = _Rows(table, buckets)
    bucket = combined(table["bucket"]).to_numpy()
    label = combined(table["label"]).dictionary_encode().indices.to_numpy()
    found_i, found_j = [], []
    for d in range(1, buckets.pair_up_to):
        i = np.flatnonzero((bucket[d:] == bucket[:-d]) & (label[d:] == label[:-d]))
        if not len(i):
            break
        i = i[(rows.main[i] | rows.main[i + d]) & (rows.node[i] != rows.node[i + d])]
        cosine = np.einsum("ij,ij->i", rows.unit[i], rows.unit[i + d])
        i = i[cosine >= buckets.cosine]
        i = i[rows.first_meeting(i, i + d)]
        found_i.append(i)
        found_j.append(i + d)
    none = np.empty(0, dtype=np.int64)
    return rows.report(
        np.concatenate(found_i) if found_i else none, np.concatenate(found_j) if found_j else none
    )


def _compare_blocks(key, table: pa.Table, *, buckets: Buckets) -> pa.Table:
    """Links between two blocks of a large bucket, or inside one."""
    rows = _Rows(table, buckets)
    low = np.flatnonzero(combined(table["is_low"]).to_numpy(zero_copy_only=False))
    high = np.flatnonzero(combined(table["is_high"]).to_numpy(zero_copy_only=False))
    near = rows.unit[low] @ rows.unit[high].T >= buckets.cosine
    # A probe meets those that live in the bucket, and not other probes.
    near &= rows.main[low][:, None] | rows.main[high][None, :]
    i, j = np.nonzero(near)
    i, j = low[i], high[j]
    inside = key[2].as_py() == key[3].as_py()
    once = rows.node[i] < rows.node[j] if inside else rows.node[i] != rows.node[j]
    i, j = i[once], j[once]
    # Which bucket a pair counts in depends on the order of its two.
    swap = rows.node[i] > rows.node[j]
    i, j = np.where(swap, j, i), np.where(swap, i, j)
    first = rows.first_meeting(i, j)
    return rows.report(i[first], j[first])


def link_vectors(
    vectors: DataFrame, buckets: Buckets = Buckets(), vector_id: str = "vec_id"
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    Rows with equal labels link if the cosine of their vectors, in double precision, is at
    least ``buckets.cosine``. Vectors that are null, empty, zero or hold null or non-finite
    components link with nothing, nor do rows without a label or of different lengths.
    ``n_links`` counts the other rows linked directly, ``component_id`` is the smallest id that
    links reach, ``kept`` tells the row that has it. Equal vectors are compared as one and
    counted as many. An id that repeats, or null, is one more row of its vector; a null id
    alone has a null component and is kept. An empty table gives no rows; other columns are
    ignored. Pairs at the threshold are found with a probability above 0.99.
    """
    require_columns(vectors, vector_id, "embedding", "label")
    id_type = vectors.schema[vector_id].dataType
    usable = F.expr(
        "label is not null and size(embedding) > 0 "
        "and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('inf')) "
        "and exists(embedding, x -> x <> 0)"
    )
    rows = vectors.select(
        F.col(vector_id).cast("long").alias("id"),
        "label",
        F.when(usable, F.col("embedding")).alias("embedding"),
    )
    # The hash names a class; where two classes had the same, vectors are compared, too.
    rows = rows.withColumn("node", F.xxhash64("label", "embedding"))
    classes = (
        rows.where("embedding is not null")
        .groupBy("node", "label", "embedding")
        .agg(F.min("id").alias("smallest"), F.count(F.lit(1)).alias("copies"))
    )
    element = classes.schema["embedding"].dataType.simpleString()
    hashed = checkpointed(
        classes.select("node", F.col("label").cast("string").alias("label"), "copies", "embedding")
        .mapInArrow(
            per_batch(lambda batch: _hash_batch(batch, buckets)),
            f"node bigint, label string, copies bigint, embedding {element}, "
            "buckets array<bigint>, short binary",
        )
    )
    take = 1 + buckets.probes
    placed = hashed.select("node", "label", F.posexplode("buckets").alias("at", "bucket")).select(
        "node", "label", "bucket",
        F.expr(f"int(at div {take})").alias("table"), (F.col("at") % take == 0).alias("main"),
    )
    shared = (
        placed.groupBy("label", "bucket")
        .agg(F.count(F.lit(1)).alias("size"), F.max("main").alias("lived_in"))
        .where("size > 1 and lived_in")
        .drop("lived_in")
    )
    met = checkpointed(placed.join(shared, ["label", "bucket"]))
    cells = -(-met.count() // CELL_ROWS) or 1
    vectors_of = hashed.select("node", "copies", "embedding", "short")
    result = "node bigint, other bigint, links bigint"
    in_cells = (
        met.where(F.col("size") <= buckets.pair_up_to)
        .withColumn("cell", F.pmod(F.xxhash64("label", "bucket"), F.lit(cells)).cast("int"))
        .join(vectors_of, "node")
        .groupBy("cell")
        .applyInArrow(of_group(_compare_cell, buckets=buckets), result)
    )
    in_blocks = (
        met.where(F.col("size") > buckets.pair_up_to)
        .withColumn("blocks", F.ceil(F.col("size") / buckets.block).cast("int"))
        .withColumn("part", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
        .withColumns({
            "low": F.least("part", "other"),
            "high": F.greatest("part", "other"),
            "is_low": F.col("part") <= F.col("other"),
            "is_high": F.col("part") >= F.col("other"),
        })
        .join(vectors_of, "node")
        .groupBy("label", "bucket", "low", "high")
        .applyInArrow(of_group(_compare_blocks, buckets=buckets), result)
    )
    found = checkpointed(in_cells.unionByName(in_blocks))
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    components = connected_components(
        found.select(F.col("node").alias("a"), F.col("other").alias("b"))
    )
    named = checkpointed(
        classes.join(counts, "node", "left")
        .join(components, "node", "left")
        .select(
            F.col("node").alias("n"), F.col("label").alias("l"), F.col("embedding").alias("e"),
            "smallest", F.coalesce("component", "node").alias("component"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        )
    )
    smallest = named.groupBy("component").agg(F.min("smallest").alias("component_id"))
    result = rows.join(
        named.join(smallest, "component"), F.expr("node = n and label = l and embedding = e"), "left"
    ).select(
        "id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
    )
    return result.select(
        F.col("id").cast(id_type).alias(vector_id),
        "n_links",
        "component_id",
        F.expr("id <=> component_id").alias("kept"),
    )
