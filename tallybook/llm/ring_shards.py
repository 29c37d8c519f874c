"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

Every shard has several points on a ring of hashes. A row belongs to the shard of the next
point clockwise from its own hash. A shard takes no more rows than its bound; what overflows
goes on clockwise to the next shard with room. With the bound at the mean, shards differ by
one row at most, and still most rows stay where the ring put them when the number of shards
changes.

All rows between two points (an arc) walk past the same shards, so the walk is computed for
arcs: a fixed number of them, however many rows there are. What an arc gives to a shard is a
range of the ranks of its rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallybook.llm.shared import require_columns

#: Positions on the ring.
RING_BITS = 32
#: Rows that are ranked together, about.
RANKED_TOGETHER = 4096


@dataclass(frozen=True)
class Ring:
    """shards: their number. points: virtual nodes of each shard.

    slack: how far the load of a shard may pass the mean, as a share of it; 0 keeps the
    numbers of rows at most one apart.
    """

    shards: int = 16
    points: int = 32
    slack: float = 0.0

    def __post_init__(self) -> None:
        if self.shards < 1 or self.points < 1 or self.slack < 0:
            raise ValueError(f"not a ring: {self}")


def _position(*key: Column) -> Column:
    """Where a key stands on the ring."""
    return F.shiftrightunsigned(F.xxhash64(*key), 64 - RING_BITS)


def ring_arcs(spark: SparkSession, ring: Ring) -> DataFrame:
    """(arc, stop, shard): arcs in ring order, each up to and including the position ``stop``.

    Rows beyond the last point belong to the first: that arc is listed twice.
    """
    shard, point = F.expr(f"int(id div {ring.points})"), F.col("id") % ring.points
    points = spark.range(ring.shards * ring.points, numPartitions=1).select(
        shard.alias("shard"), _position(F.lit("point"), shard, point).alias("stop")
    )
    order = Window.orderBy("stop", "shard")
    arcs = points.select(
        (F.row_number().over(order) - 1).cast("int").alias("arc"), "stop", "shard"
    )
    last = arcs.where("arc = 0").select("arc", F.lit(2**RING_BITS).alias("stop"), "shard")
    return arcs.unionByName(last)


def _stops(arcs: DataFrame) -> DataFrame:
    """The arcs as one row with a sorted array, to be searched by every row."""
    return arcs.agg(F.sort_array(F.collect_list(F.struct("stop", "arc"))).alias("stops"))


# Halving steps that find the first stop at or after a position, for up to 2 ** 20 stops.
_SEARCH = """
aggregate(sequence(1, {steps}), named_struct('low', 0, 'high', size(stops) - 1),
  (at, step) -> if(at.low < at.high,
    if(stops[(at.low + at.high) div 2].stop >= position,
       named_struct('low', at.low, 'high', int((at.low + at.high) div 2)),
       named_struct('low', int((at.low + at.high) div 2) + 1, 'high', at.high)),
    at),
  at -> stops[at.low].arc)
"""


def ring_flow(arc_loads: DataFrame, arcs: DataFrame, ring: Ring) -> DataFrame:
    """(arc, shares): which ranks of each arc go to which shard, and to which slots.

    Arcs offer their rows to the shard at their end, in ring order; what a full shard cannot
    take is offered to the next, and so on. ``arc_loads`` has (arc, load) of a fixed number of
    arcs. The walk is one fold over arcs x shards offers.
    """
    points = arcs.where(F.col("stop") < 2**RING_BITS)
    loads = points.join(arc_loads, "arc", "left").select(
        "arc", "shard", F.coalesce("load", F.lit(0)).cast("long").alias("load")
    )
    whole = loads.agg(
        F.sort_array(F.collect_list(F.struct("arc", "shard", "load"))).alias("arcs"),
        F.sum("load").alias("total"),
    )
    n = ring.shards
    bounds = whole.withColumn(
        "bounds",
        F.expr(
            f"transform(sequence(0, {n - 1}), s -> "
            f"greatest(bigint(ceil(total * {1 + ring.slack!r}D / {n})) * {int(ring.slack > 0)}, "
            f"total div {n} + if(s < total % {n}, 1L, 0L)))"
        ),
    )
    # The shards that an arc meets, each once: its own, then the next ones clockwise.
    met = bounds.select(
        "bounds",
        F.expr(
            "transform(arcs, (a, i) -> named_struct('arc', a.arc, 'load', a.load, 'met', "
            "array_distinct(transform(sequence(0, size(arcs) - 1), "
            "k -> arcs[(i + k) % size(arcs)].shard))))"
        ).alias("arcs"),
    )
    offers = met.select(
        "arcs",
        "bounds",
        F.expr(
            f"flatten(transform(sequence(0, {n - 1}), k -> transform(arcs, a -> "
            "named_struct('arc', a.arc, 'shard', a.met[k]))))"
        ).alias("offers"),
    )
    walked = offers.select(
        F.expr(
            "aggregate(offers, named_struct("
            "'room', bounds, 'left', transform(arcs, a -> a.load), "
            "'taken', cast(array() as array<struct<arc:int,shard:int,n:bigint,done:bigint>>)), "
            "(at, o) -> if(at.left[o.arc] = 0 or at.room[o.shard] = 0, at, named_struct("
            "'room', transform(at.room, (x, i) -> "
            "if(i = o.shard, x - least(x, at.left[o.arc]), x)), "
            "'left', transform(at.left, (x, i) -> "
            "if(i = o.arc, x - least(x, at.room[o.shard]), x)), "
            "'taken', concat(at.taken, array(named_struct('arc', o.arc, 'shard', o.shard, "
            "'n', least(at.room[o.shard], at.left[o.arc]), "
            "'done', at.room[o.shard]))))), "
            "at -> transform(at.taken, t -> named_struct('arc', t.arc, 'shard', t.shard, "
            "'n', t.n, 'slot', bounds[t.shard] - t.done)))"
        ).alias("taken")
    ).select(F.posexplode("taken").alias("turn", "t"))
    # An arc's shares in the order of its walk: the first shard takes the first ranks.
    order = walked.select("t.*", "turn")
    before = Window.partitionBy("arc").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    return (
        order.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .groupBy("arc")
        .agg(F.sort_array(F.collect_list(F.struct("start", "n", "shard", "slot"))).alias("shares"))
    )


def ring_shards(docs: DataFrame, ring: Ring, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, size, text_crc32, shard, slot) of every row.

    ``size`` is the text's UTF-8 bytes plus 1, and a null text counts as empty; slots number
    the rows of a shard from 0 without gaps. Rows stand on the ring by the hash of key and
    text. Equal rows are counted, not carried: however often one repeats, it is one row until
    the result is spread out. A null key is a key like any other; an empty table gives no rows;
    other columns are ignored.
    """
    require_columns(docs, key, text)
    spark = docs.sparkSession
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(key).alias("_key"),
        (F.octet_length(body) + F.lit(1)).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        _position(F.col(key), body).alias("position"),
    )
    counted = rows.groupBy("_key", "size", "text_crc32", "position").agg(
        F.count(F.lit(1)).alias("repeats")
    )
    arcs = ring_arcs(spark, ring)
    # One row of shards x points stops.
    search = _SEARCH.format(steps=(ring.shards * ring.points + 1).bit_length() + 1)
    placed = counted.withColumn("stops", _stops(arcs).scalar()).select(
        "_key", "size", "text_crc32", "position", "repeats", F.expr(search).alias("arc")
    )
    # Positions are even, so bins of equal width have about equally many different rows.
    total = rows.agg(F.count(F.lit(1)).alias("n"))
    width = total.select(
        F.greatest(
            F.lit(1), F.floor(F.lit(2.0**RING_BITS) * RANKED_TOGETHER / F.greatest("n", F.lit(1)))
        ).alias("width")
    )
    placed = placed.withColumn("bin", F.floor(F.col("position") / width.scalar()))
    bins = placed.groupBy("arc", "bin").agg(F.sum("repeats").alias("load"))
    flow = ring_flow(bins.groupBy("arc").agg(F.sum("load").alias("load")), arcs, ring)
    # An arc has few bins each: offsets are sums over the bins of an arc.
    earlier = Window.partitionBy("arc").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    offsets = bins.select(
        "arc", "bin", F.coalesce(F.sum("load").over(earlier), F.lit(0)).alias("offset")
    )
    inside = (
        Window.partitionBy("arc", "bin")
        .orderBy("position", "_key", "size", "text_crc32")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    ranked = placed.withColumn(
        "rank", F.coalesce(F.sum("repeats").over(inside), F.lit(0))
    ).join(offsets, ["arc", "bin"])
    spread = ranked.select(
        "_key",
        "size",
        "text_crc32",
        "arc",
        F.explode(
            F.sequence(
                F.col("offset") + F.col("rank"),
                F.col("offset") + F.col("rank") + F.col("repeats") - 1,
            )
        ).alias("rank"),
    )
    # As many rows as there are arcs.
    shared = spread.join(F.broadcast(flow), "arc").withColumn(
        "share", F.expr("filter(shares, s -> rank >= s.start and rank < s.start + s.n)[0]")
    )
    return shared.select(
        F.col("_key").alias(key),
        "size",
        "text_crc32",
        F.col("share.shard").alias("shard"),
        (F.col("share.slot") + F.col("rank") - F.col("share.start")).alias("slot"),
    )
