"""Joining documents by the Jaccard similarity of their word n-grams.

Sets that reach the threshold share tokens early in any common order of tokens. With the
rarest tokens first, two sets of similarity t share at least l tokens among the first
n - ceil(t n) + l of each. A longer prefix asks for more shared tokens; every document takes
the l at which the estimated cost of listing and comparing its candidates is smallest, and a
pair has to share as many as the smaller l of the two.

Tokens that one document alone has cannot be shared: how often a token occurs is asked of the
whole corpus, and a set with too few shared tokens leaves the join at once. The join then works
in rounds. The first compares each document with the hubs of its tokens only, which gathers
near copies around hubs. The last compares what documents of different hubs still share, with
the full condition, so that no link between different groups is missed.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybook.llm.chunks import (
    ANSWERED,
    ASKED,
    Words,
    answered,
    answers_in_order,
    asked,
    chunk_count,
    chunk_of,
    combined,
    slices,
)
from tallybook.llm.components import connected_components
from tallybook.llm.shared import checkpointed, of_cogroup, of_group, per_batch, require_columns


@dataclass(frozen=True)
class Join:
    """words: length of the n-grams. percent: least similarity.

    longest: how far l may go. compare_cost: cost of comparing a candidate, where listing one
    costs 1. hub_rounds, hubs: rounds with hubs, and hubs of a document in each; they
    change the work, not the result. pair_up_to: a token with more documents has them compared
    in blocks of about ``block``.
    """

    words: int = 5
    percent: int = 80
    longest: int = 6
    compare_cost: float = 8.0
    hub_rounds: int = 1
    hubs: int = 2
    pair_up_to: int = 64
    block: int = 256

    def __post_init__(self) -> None:
        if self.words < 1 or not 0 < self.percent <= 100 or self.longest < 1:
            raise ValueError(f"not a join: {self}")


def token_sets(text: pa.Array, words: int) -> list[np.ndarray]:
    """Of each text the sorted different hashes of its n-grams; a short text is one n-gram."""
    found = Words(text, lower=True)
    grams, whole = found.grams(words)
    sets = []
    for a, b in zip(found.first[:-1].tolist(), found.first[1:].tolist(), strict=True):
        if b - a >= words:
            sets.append(np.unique(grams[a : b - words + 1]))
        elif b > a:
            # Another length is another n-gram, so it gets a hash of its own.
            one = found.hash[a:b]
            value = np.uint64(b - a)
            for h in one:
                value = (value ^ h) * np.uint64(0x9E3779B97F4A7C15)
            sets.append(np.array([value]))
        else:
            sets.append(np.empty(0, np.uint64))
    return sets


def _chunk_sets(docs: pa.Table, words: int) -> list[np.ndarray]:
    text = combined(docs["text"])
    with np.errstate(over="ignore"):
        return [s for a, b in slices(text) for s in token_sets(text[a:b], words)]


def _firsts(docs: pa.Table, copies: pa.Table) -> np.ndarray:
    """Which rows stand for their text: no copy of another row, and not repeated."""
    known = set(combined(copies["copy"]).to_pylist())
    firsts = np.zeros(docs.num_rows, dtype=bool)
    for i, key in enumerate(combined(docs["key"]).to_pylist()):
        if key not in known:
            known.add(key)
            firsts[i] = True
    return firsts


def _counted(sets: list[np.ndarray], firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    chosen = [s for s, first in zip(sets, firsts, strict=True) if first]
    if not chosen:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.unique(np.concatenate(chosen), return_counts=True)


def _ask(key, docs: pa.Table, copies: pa.Table, *, join: Join, buckets: int) -> pa.Table:
    hashes, counts = _counted(_chunk_sets(docs, join.words), _firsts(docs, copies))
    low, few = hashes.astype(np.uint32), np.minimum(counts, 255).astype(np.uint8)
    return asked(
        key[0].as_py(), hashes, buckets, lambda a, b: low[a:b].tobytes() + few[a:b].tobytes()
    )


def _answer(key, table: pa.Table) -> pa.Table:
    """A byte for each token: the digits of the number of documents that have it, less one."""
    del key
    blobs = table["data"].to_pylist()
    sizes = [len(blob) // 5 for blob in blobs]
    hashes = np.concatenate([np.frombuffer(b, np.uint32, n) for b, n in zip(blobs, sizes)])
    counts = np.concatenate([np.frombuffer(b, np.uint8, n, 4 * n) for b, n in zip(blobs, sizes)])
    order = np.argsort(hashes, kind="stable")
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = hashes[order][1:] != hashes[order][:-1]
    group = np.cumsum(new) - 1
    total = np.bincount(group, weights=counts[order])
    levels = np.empty(len(hashes), dtype=np.uint8)
    levels[order] = np.floor(np.log2(total)).astype(np.uint8)[group]
    ends = np.cumsum(sizes)
    return answered(
        0, table, [levels[e - n : e].tobytes() for e, n in zip(ends, sizes, strict=True)]
    )


def prefix(levels: np.ndarray, n: int, join: Join) -> tuple[int, int]:
    """(l, length): the cheapest l, and how many of the shared tokens its prefix has.

    ``levels`` are those of the shared tokens, rarest first; the n - len(levels) others come
    before them. A token of level v is in about 2 ** v documents.
    """
    least = -(-join.percent * n // 100)
    alone = n - len(levels)
    lists = np.cumsum(2.0 ** levels.astype(np.float64))
    best, at, cost = 1, 0, np.inf
    for ell in range(1, join.longest + 1):
        length = n - least + ell - alone
        if length > len(levels) or ell > least:
            break
        listed = lists[length - 1]
        now = listed * (1 + join.compare_cost / ell)
        if now < cost:
            best, at, cost = ell, length, now
    return best, at


def _describe(key, docs: pa.Table, more: pa.Table, *, join: Join, buckets: int) -> pa.Table:
    del key, buckets
    firsts = _firsts(docs, more.filter(pc.is_valid(more["copy"])))
    sets = _chunk_sets(docs, join.words)
    hashes, _ = _counted(sets, firsts)
    parts = answers_in_order(more.filter(pc.is_valid(more["data"])), 0)
    levels = np.frombuffer(b"".join(parts), np.uint8)
    tokens, prefixes, ells = [], [], []
    for s, first in zip(sets, firsts, strict=True):
        row = None
        if first and len(s):
            level = levels[np.searchsorted(hashes, s)]
            shared = level > 0
            if 100 * int(shared.sum()) >= join.percent * len(s):
                level, own = level[shared], s[shared]
                order = np.lexsort((own, level))
                ell, length = prefix(level[order], len(s), join)
                row = own.tobytes(), own[order][:length].view(np.int64).tolist(), ell
        tokens.append(row and row[0])
        prefixes.append(row and row[1])
        ells.append(row and row[2])
    return pa.table(
        {
            "doc_id": combined(docs["doc_id"]),
            "key": combined(docs["key"]),
            "n": pa.array([len(s) for s in sets], pa.int64()),
            "ell": pa.array(ells, pa.int32()),
            "tokens": pa.array(tokens, pa.binary()),
            "prefix": pa.array(prefixes, pa.list_(pa.int64())),
        }
    )


def _overlap(batch: pa.RecordBatch, percent: int) -> pa.RecordBatch:
    n, m = batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy()
    shared = np.array(
        [
            len(np.intersect1d(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), True))
            for a, b in zip(
                batch.column("tokens_a").to_pylist(),
                batch.column("tokens_b").to_pylist(),
                strict=True,
            )
        ],
        dtype=np.int64,
    )
    linked = pa.array(100 * shared >= percent * (n + m - shared))
    return batch.select(["a", "b"]).filter(linked)


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, b) of keys those that reach the threshold; shared tokens decide it."""
    left = sets.select(F.col("key").alias("a"), F.col("n").alias("n_a"), F.col("tokens").alias("tokens_a"))
    right = sets.select(F.col("key").alias("b"), F.col("n").alias("n_b"), F.col("tokens").alias("tokens_b"))
    schema = pairs.select("a", "b").schema
    return (
        pairs.select("a", "b").join(left, "a").join(right, "b")
        .select("a", "b", "n_a", "n_b", "tokens_a", "tokens_b")
        .mapInArrow(per_batch(lambda batch: _overlap(batch, percent)), schema)
    )


def _near_size(join: Join, n: str, m: str) -> str:
    return f"100 * least({n}, {m}) >= {join.percent} * greatest({n}, {m})"


def _hub_pairs(postings: DataFrame, join: Join, turn: int) -> DataFrame:
    """Each document with the hubs that most of its tokens have: (a, b) with b the hub.

    A token's hub is the document first in an order that is drawn anew for every round.
    """
    hubs = postings.groupBy("token").agg(
        F.min_by(F.struct("key", "n", "label"), F.xxhash64("key", F.lit(turn))).alias("hub")
    )
    counts = (
        postings.join(hubs, "token")
        .where("key <> hub.key and label <> hub.label")
        .where(_near_size(join, "n", "hub.n"))
        .groupBy(F.col("key").alias("a"), F.col("hub.key").alias("b"))
        .count()
    )
    best = Window.partitionBy("a").orderBy(F.desc("count"), "b")
    return (
        counts.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= join.hubs)
        .select("a", "b")
    )


def _crossing(postings: DataFrame) -> DataFrame:
    """Postings of the tokens that documents of different labels have."""
    mixed = (
        postings.groupBy("token")
        .agg(F.min("label").alias("low"), F.max("label").alias("high"))
        .where("low <> high")
    )
    return postings.join(mixed.select("token"), "token", "left_semi")


def _remaining_pairs(postings: DataFrame, join: Join) -> DataFrame:
    """All pairs of documents of different labels that share enough of their prefixes."""
    left = postings.select("token", F.col("key").alias("a"), F.col("n").alias("n_a"), F.col("ell").alias("ell_a"), F.col("label").alias("low"))
    right = postings.select("token", F.col("key").alias("b"), F.col("n").alias("n_b"), F.col("ell").alias("ell_b"), F.col("label").alias("high"))
    return (
        left.join(right, "token")
        .where(f"low < high and {_near_size(join, 'n_a', 'n_b')}")
        .groupBy("a", "b")
        .agg(F.count(F.lit(1)).alias("shared"), F.min(F.least("ell_a", "ell_b")).alias("needed"))
        .where("shared >= needed")
        .select("a", "b")
    )


def _block_links(postings: DataFrame, sets: DataFrame, join: Join) -> DataFrame:
    """Links (a, b) that connect what tokens with many documents bring together.

    Listing the pairs of such a token would be quadratic, and the pairs of a large group of
    near copies share many of them. Documents with common tokens form a group, blocks of it are
    compared in tasks, and a pair of blocks sends links that connect its documents, not all.
    """
    stars = postings.join(
        postings.groupBy("token").agg(F.min("key").alias("hub")), "token"
    ).select(F.col("hub").alias("a"), F.col("key").alias("b"))
    regions = connected_components(stars).select(
        F.col("node").alias("key"), F.col("component").alias("region")
    )
    placed = postings.select("token", "key", "members").join(regions, "key")
    tokens = placed.groupBy("region", "token").agg(F.first("members").alias("members"))
    costs = tokens.groupBy("region").agg(F.sum(F.col("members") * F.col("members")).alias("apart"))
    sizes = placed.groupBy("region").agg(F.count_distinct("key").alias("size"))
    # A group is a region, or a token of it, whichever has fewer pairs.
    chosen = costs.join(sizes, "region").withColumn(
        "whole", F.col("size") * F.col("size") <= F.col("apart")
    )
    members = (
        placed.join(chosen, "region")
        .select(
            F.when(F.col("whole"), F.col("region")).otherwise(F.col("token").cast("string")).alias("group"),
            F.when(F.col("whole"), F.col("size")).otherwise(F.col("members")).alias("size"),
            "key",
        )
        .distinct()
        .withColumn("blocks", F.ceil(F.col("size") / join.block).cast("int"))
        .withColumn("block", F.pmod(F.xxhash64("key", F.lit("block")), F.col("blocks")).cast("int"))
    )
    dealt = (
        members.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
        .select(
            "group",
            F.least("block", "other").alias("low"),
            F.greatest("block", "other").alias("high"),
            (F.col("block") <= F.col("other")).alias("is_low"),
            (F.col("block") >= F.col("other")).alias("is_high"),
            "key",
        )
        .join(sets.select("key", "n", "tokens"), "key")
    )
    return dealt.groupBy("group", "low", "high").applyInArrow(
        of_group(_compare_blocks, percent=join.percent), "a string, b string"
    )


#: Tokens that are compared at once.
COLUMNS = 4096


def _compare_blocks(key, table: pa.Table, *, percent: int) -> pa.Table:
    del key
    keys = np.array(combined(table["key"]).to_pylist(), dtype=object)
    n = combined(table["n"]).to_numpy()
    sets = [np.frombuffer(t, np.uint64) for t in table["tokens"].to_pylist()]
    low = np.flatnonzero(combined(table["is_low"]).to_numpy(zero_copy_only=False))
    high = np.flatnonzero(combined(table["is_high"]).to_numpy(zero_copy_only=False))
    shared = np.zeros((len(low), len(high)), dtype=np.float32)
    rows, columns = _incidence(sets)
    width = int(columns.max(initial=-1)) + 1
    for start in range(0, width, COLUMNS):
        part = (columns >= start) & (columns < start + COLUMNS)
        matrix = np.zeros((len(sets), min(COLUMNS, width - start)), dtype=np.float32)
        matrix[rows[part], columns[part] - start] = 1
        shared += matrix[low] @ matrix[high].T
    union = n[low][:, None] + n[high][None, :] - shared
    linked = (100 * shared >= percent * union) & (low[:, None] != high[None, :])
    # The smallest row that each row reaches inside this pair of blocks.
    label = np.arange(len(sets))
    while True:
        old = label.copy()
        reach = np.where(linked, label[high][None, :], len(sets)).min(axis=1, initial=len(sets))
        label[low] = np.minimum(label[low], reach)
        reach = np.where(linked, label[low][:, None], len(sets)).min(axis=0, initial=len(sets))
        label[high] = np.minimum(label[high], reach)
        if (label == old).all():
            break
    moved = np.flatnonzero(label != np.arange(len(sets)))
    return pa.table(
        {
            "a": pa.array(keys[moved].tolist(), pa.string()),
            "b": pa.array(keys[label[moved]].tolist(), pa.string()),
        }
    )


def _incidence(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of tokens that more than one of the sets has."""
    tokens = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, count = np.unique(tokens, return_inverse=True, return_counts=True)
    common = count[column] > 1
    renumbered = np.cumsum(count > 1) - 1
    return rows[common], renumbered[column[common]]


def _postings(slim: DataFrame) -> DataFrame:
    """(key, n, ell, label, token): the prefix tokens."""
    return slim.select("key", "n", "ell", "label", F.explode("prefix").alias("token"))


def _relabelled(slim: DataFrame, links: DataFrame) -> DataFrame:
    """The sets with the label of the first hub that they are linked with, and of its hub.

    Equal labels mean that links connect; different ones mean nothing. A short way from a
    document to a hub that many share is enough here, and takes no iteration.
    """
    hubs = links.groupBy(F.col("a").alias("x")).agg(F.min("b").alias("hub"))
    further = hubs.select(F.col("x").alias("y"), F.col("hub").alias("hub_of_hub"))
    found = hubs.join(further, F.col("hub") == F.col("y"), "left").select(
        "x", F.coalesce("hub_of_hub", "hub").alias("to")
    )
    labels = slim.join(found, slim["key"] == found["x"], "left").select(
        "key", "n", "ell", "prefix",
        F.when(F.col("label") == F.col("key"), F.coalesce("to", "label")).otherwise(F.col("label")).alias("label"),
    )
    return checkpointed(labels)


def text_key(text: str) -> Column:
    """What equal texts have in common."""
    return F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))


def similar_components(docs: DataFrame, join: Join = Join()) -> DataFrame:
    """(doc_id, text_key, n_shingles, component_id) of every row.

    Words are separated by ASCII white space and compared with A-Z in lower case. A document's
    set has its n-grams of words; a document with fewer words is one n-gram, and one without
    words or with a null text has none and is linked with nothing, not even with its like.
    ``component_id`` is the smallest doc_id that links reach, itself included. Rows with equal
    ids are one node. A row without an id takes part by its text but is nobody's smallest id;
    alone, its component is null. An empty table gives no rows; other columns are ignored.
    """
    require_columns(docs, "doc_id", "text")
    count = chunk_count(docs)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    # Equal texts are one node, keyed by their hash. Which row stands for it is found on ids
    # and hashes alone, so that copies of a text are dealt to chunks like any other rows.
    keyed = docs.select(
        "doc_id",
        text_key("text").alias("key"),
        "text",
        chunk_of(count, "doc_id", "text").alias("chunk"),
    )
    spread = keyed.groupBy("key").agg(
        F.min(F.struct("chunk", "doc_id")).alias("first"), F.count(F.lit(1)).alias("rows")
    )
    copies = (
        keyed.select("key", "chunk")
        .distinct()
        .join(spread.where("rows > 1"), "key")
        .where("chunk <> first.chunk")
        .select(F.col("chunk").alias("chunk"), F.col("key").alias("copy"))
    )
    given = {"join": join, "buckets": count}
    questions = (
        keyed.groupBy("chunk")
        .cogroup(copies.groupBy("chunk"))
        .applyInArrow(of_cogroup(_ask, **given), ASKED)
    )
    replies = questions.groupBy("bucket").applyInArrow(of_group(_answer), ANSWERED)
    more = replies.unionByName(copies, allowMissingColumns=True)
    described = checkpointed(
        keyed.groupBy("chunk")
        .cogroup(more.groupBy("chunk"))
        .applyInArrow(
            of_cogroup(_describe, **given),
            f"doc_id {id_type}, key string, n bigint, ell int, tokens binary, "
            "prefix array<bigint>",
        )
    )
    return _grouped(described, join)


def _grouped(described: DataFrame, join: Join) -> DataFrame:
    sets = described.where("tokens is not null").select("key", "n", "ell", "tokens", "prefix")
    slim = sets.select("key", "n", "ell", "prefix", F.col("key").alias("label"))
    edges = None
    for turn in range(join.hub_rounds):
        pairs = _hub_pairs(_postings(slim), join, turn)
        new = checkpointed(_links(pairs, sets, join.percent))
        edges = new if edges is None else edges.unionByName(new)
        slim = _relabelled(slim, new)
    postings = _crossing(_postings(slim))
    sized = checkpointed(
        postings.join(
            postings.groupBy("token").agg(F.count(F.lit(1)).alias("members")), "token"
        )
    )
    few = sized.where(F.col("members") <= join.pair_up_to)
    many = sized.where(F.col("members") > join.pair_up_to)
    rest = _links(_remaining_pairs(few, join), sets, join.percent)
    if not many.isEmpty():
        rest = rest.unionByName(_block_links(many, sets, join))
    edges = checkpointed(rest if edges is None else edges.unionByName(rest))
    # Rows with equal ids are one node, too: their texts are linked through the id.
    ids = described.where("n > 0").select(F.col("doc_id").cast("string").alias("id"), "key")
    return _with_components(described, ids, edges)


def _with_components(described: DataFrame, ids: DataFrame, edges: DataFrame) -> DataFrame:
    repeated = ids.where("id is not null").groupBy("id").agg(
        F.min("key").alias("a"), F.max("key").alias("b")
    )
    repeated = (
        ids.join(repeated.where("a <> b"), "id").select("a", F.col("key").alias("b"))
    )
    found = connected_components(edges.unionByName(repeated))
    nodes = described.where("n > 0").join(found, described["key"] == found["node"], "left").select(
        described["doc_id"], described["key"], described["n"],
        F.coalesce("component", "key").alias("component"),
    )
    smallest = nodes.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    linked = nodes.join(smallest, "component")
    alone = described.where("n = 0").withColumn("component_id", F.col("doc_id"))
    columns = ["doc_id", F.col("key").alias("text_key"), F.col("n").alias("n_shingles"), "component_id"]
    return linked.select(*columns).unionByName(alone.select(*columns))
