"""Mixing sources to target weights by entropy balancing.

Among all document rates r between 0 and a limit m that give every source its target of
words, the balanced ones have the largest entropy relative to taking each document once:

    minimise  sum_i  r log(r) + (m - r) log((m - r) / (m - 1))
    subject to  sum over a source's documents of r * size = its target.

The dual has one multiplier for each source, and its solution tilts the rates exponentially
in the size: the odds r / (m - r) are exp(lambda * size) / (m - 1). Newton steps find the
multipliers; each is a sum over the whole table, over counts by (source, size). The rates
become whole numbers of copies by cuts through a queue of each source's documents, which meet
its target to within about its smallest documents.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybook.llm.shared import checkpointed, n_words, require_columns

# A tilt stays if its words are as close to the target, or the next step is as short.
CLOSE, ROUNDING = 1e-9, 1e-13
#: Columns that the mix adds.
MIXED_COLUMNS = ("size", "source_size", "target", "copies", "taken")


@dataclass(frozen=True)
class Mix:
    """weights: of the sources in code point order, repeating. most: copies of a document.

    steps: Newton steps at most. bins, rounds: a cut is searched in so many bins, each round inside one
    bin of the round before. passes: how often the rest is filled with documents that fit.
    """

    weights: tuple[int, ...] = (1, 2, 3)
    most: int = 3
    steps: int = 12
    bins: int = 1024
    rounds: int = 2
    passes: int = 3

    def __post_init__(self) -> None:
        if not self.weights or min(self.weights) <= 0 or self.most < 2:
            raise ValueError(f"not a mix: {self}")


def source_targets(sizes: DataFrame, mix: Mix) -> DataFrame:
    """(source, source_size, target) from rows (source, size).

    Targets share the total by weight. One above ``most`` times its source stops there, and the
    excess goes to the others by weight, until none is above. In the order of most * size / weight
    the stopped sources come first, so one pass over the sources finds them.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    weights = F.array(*[F.lit(w) for w in mix.weights])
    # Windows over sources: one row each.
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    weighed = totals.withColumn(
        "weight",
        F.element_at(
            weights, (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(mix.weights))) + 1)
        ),
    ).withColumn("most", F.col("source_size") * mix.most)
    by_room = Window.orderBy(F.col("most") / F.col("weight"), F.asc_nulls_last("source"))
    up_to = by_room.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_room.rowsBetween(0, Window.unboundedFollowing)
    everything = by_room.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levelled = weighed.select(
        "source",
        "source_size",
        "weight",
        "most",
        (
            (F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(up_to), F.lit(0)))
            / F.sum("weight").over(onward)
        ).alias("level"),
        F.row_number().over(by_room).alias("rank"),
    )
    # The level that holds is that of the first source with room.
    room = F.col("level") * F.col("weight") <= F.col("most")
    held = levelled.withColumn(
        "level", F.min_by(F.when(room, F.col("level")), F.when(room, F.col("rank"))).over(everything)
    )
    return held.select(
        "source",
        "source_size",
        F.least(F.col("level") * F.col("weight"), F.col("most").cast("double")).alias("target"),
    )


def _rate(mix: Mix, tilt: Column, size: Column) -> Column:
    """Copies of a document: most at an infinite tilt, 1 at none, 0 at minus infinity."""
    return F.lit(float(mix.most)) / (F.lit(1.0) + F.lit(mix.most - 1.0) * F.exp(-tilt * size))


def source_tilts(counts: DataFrame, targets: DataFrame, mix: Mix) -> DataFrame:
    """(source, source_size, target, tilt) from counts (source, size, docs).

    Newton's method on the dual, one source beside the other. The sum of words rises with the
    tilt, so every step also narrows an interval around the root, and a step that would leave
    it halves it instead. A tilt that meets the target stays.
    """
    # In units of the mean size of a document, tilts are of the order of 1.
    scale = counts.groupBy("source").agg(
        (F.sum(F.col("size") * F.col("docs")) / F.sum("docs")).alias("unit"),
        F.max("size").alias("largest"),
    )
    state = targets.join(scale.withColumnRenamed("source", "s"), F.expr("source <=> s")).select(
        "source", "source_size", "target", "unit",
        F.lit(0.0).alias("tilt"),
        # Beyond these the smallest document is as good as taken fully, or not at all.
        (F.lit(-60.0) * F.greatest("unit", F.lit(1.0))).alias("low"),
        (F.lit(60.0) * F.greatest("unit", F.lit(1.0))).alias("high"),
    )
    state = checkpointed(state)
    for _ in range(mix.steps):
        state = checkpointed(_newton_step(counts, state, mix))
        if state.where("NOT met").isEmpty():
            break
    return state.select(
        "source", "source_size", "target",
        (F.col("tilt") / F.greatest("unit", F.lit(1.0))).alias("tilt"),
    )


def _newton_step(counts: DataFrame, state: DataFrame, mix: Mix) -> DataFrame:
    x = F.col("size") / F.greatest("unit", F.lit(1.0))
    rate = _rate(mix, F.col("tilt"), x)
    words = F.col("size") * F.col("docs")

    def exact(value: Column) -> Column:
        # Sums of decimals do not depend on the order of the rows, so reruns find equal tilts.
        return F.sum(value.cast("decimal(38,9)")).cast("double")

    sums = (
        counts.select(F.col("source").alias("s"), "size", "docs")
        .join(state, F.expr("source <=> s"))
        .groupBy("s")
        .agg(
            exact(words * rate).alias("taken"),
            exact(words * x * rate * (mix.most - rate) / mix.most).alias("slope"),
        )
    )
    moved = state.join(sums, F.expr("source <=> s"))
    low = F.when(F.col("taken") < F.col("target"), F.col("tilt")).otherwise(F.col("low"))
    high = F.when(F.col("taken") >= F.col("target"), F.col("tilt")).otherwise(F.col("high"))
    step = F.col("tilt") + F.expr("try_divide(target - taken, slope)")
    met = (F.abs(F.col("target") - F.col("taken")) <= F.col("target") * CLOSE) | (
        F.abs(F.col("step") - F.col("tilt")) <= F.abs("tilt") * ROUNDING
    )
    return moved.withColumns({"low": low, "high": high, "step": step}).select(
        "source", "source_size", "target", "unit",
        # Newton comes from one side, so at the root a step ends on a bound of the interval.
        F.when(met, F.col("tilt"))
        .when((F.col("step") > F.col("low")) & (F.col("step") < F.col("high")), F.col("step"))
        .otherwise((F.col("low") + F.col("high")) / 2)
        .alias("tilt"),
        "low", "high", met.alias("met"),
    )


def _cuts(rated: DataFrame, targets: DataFrame, mix: Mix) -> DataFrame:
    """(source, cuts): documents below a cut whose size is within its limit get one copy more.

    A document has ``floor`` copies for sure and stands at ``turn`` in the queue for another;
    the larger its fraction, the earlier. The first cut is where the words of the queue would
    pass what the source still needs. From there on the queue is passed again for documents
    that fit into the rest, and so on. Each cut is searched by binned sums, in ever finer bins.
    """
    sure = rated.groupBy(F.col("source").alias("s")).agg(
        F.sum(F.col("size") * F.col("floor")).alias("sure")
    )
    state = checkpointed(
        targets.join(sure, F.expr("source <=> s"), "left").select(
            "source",
            (F.col("target") - F.coalesce("sure", F.lit(0))).alias("need"),
            F.lit(float("inf")).alias("limit"),
            F.lit(-1.0).alias("start"),
            F.expr("cast(array() as array<struct<limit:double,cut:double>>)").alias("cuts"),
        )
    )
    for _ in range(mix.passes):
        width = 2.0
        for _ in range(mix.rounds):
            width /= mix.bins
            state = checkpointed(_next_bin(rated, state, width, mix))
        state = state.select(
            "source",
            "need",
            F.col("need").alias("limit"),
            "start",
            F.concat("cuts", F.array(F.struct("limit", F.col("start").alias("cut")))).alias("cuts"),
        )
    return state.select("source", "cuts")


def _next_bin(rated: DataFrame, state: DataFrame, width: float, mix: Mix) -> DataFrame:
    """The state at the bin in which the need is met; beyond the last bin if it never is."""
    bins = (
        rated.where("queued")
        .select(F.col("source").alias("s"), "size", "turn")
        .join(state, F.expr("source <=> s"))
        .where("size <= limit")
        .withColumn("bin", F.floor((F.col("turn") - F.col("start")) / width))
        .where(F.col("bin").between(0, mix.bins - 1))
        .groupBy("s", "need", "bin")
        .agg(F.sum("size").alias("words"))
    )
    # As many rows as there are bins in a source.
    up_to = Window.partitionBy("s").orderBy("bin")
    met = (
        bins.withColumn("sum", F.sum("words").over(up_to))
        .groupBy("s")
        .agg(
            F.max(F.when(F.col("sum") <= F.col("need"), F.col("sum"))).alias("inner"),
            F.min(F.when(F.col("sum") > F.col("need"), F.col("bin"))).alias("next"),
        )
    )
    return state.join(met, F.expr("source <=> s"), "left").select(
        "source",
        (F.col("need") - F.coalesce("inner", F.lit(0))).alias("need"),
        "limit",
        (F.col("start") + width * F.coalesce("next", F.lit(mix.bins))).alias("start"),
        "cuts",
    )


def mix_sources(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """Rows (doc_id, size, source_size, target, copies, taken) and the other given columns.

    ``size`` counts the words of a text (null: 0), ``copies`` says how often the mix takes the
    document, ``taken`` its words with repeats. Sources are told apart by code point, and
    documents without one are a source of their own, last in order. Copies depend on size,
    source and the hash of id and text, so reruns agree and equal rows are treated alike.
    Documents without words are taken once. An empty table gives no rows. Given columns may have
    any names; those that clash with the new ones are replaced.
    """
    kept = [F.col("given")[name].alias(name) for name in docs.columns if name not in MIXED_COLUMNS]
    return mixed_rows(docs, mix).select(*kept, *MIXED_COLUMNS)


def mixed_rows(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """(given, size, source_size, target, copies, taken): ``given`` holds each row as it is."""
    require_columns(docs, "doc_id", "text", "source")
    # Queue places are even by hash, so that neither ids nor sizes decide.
    place = F.shiftrightunsigned(
        F.xxhash64("doc_id", F.coalesce(F.col("text"), F.lit(""))), 11
    ) / F.lit(2.0**53)
    # In one struct, the given columns clash with nothing.
    sized = docs.select(
        F.struct("*").alias("given"), "source", n_words("text").alias("size"), place.alias("place")
    )
    # The texts are read here and once more at the end.
    slim = checkpointed(sized.drop("given"))
    tilts = checkpointed(_balanced(slim, mix))
    rated = checkpointed(
        _rated(slim, tilts, mix).select("source", "size", "floor", "queued", "turn")
    )
    cuts = _cuts(rated, tilts.select("source", "target"), mix)
    mixed = _rated(sized, tilts, mix).join(
        cuts.withColumnRenamed("source", "s"), F.expr("source <=> s")
    )
    one_more = F.col("queued") & F.expr("exists(cuts, c -> size <= c.limit and turn < c.cut)")
    copies = (F.col("floor") + one_more.cast("long")).cast("long")
    return mixed.withColumn("copies", copies).select(
        "given", "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def _balanced(slim: DataFrame, mix: Mix) -> DataFrame:
    counts = checkpointed(slim.groupBy("source", "size").agg(F.count(F.lit(1)).alias("docs")))
    targets = source_targets(
        counts.select("source", (F.col("size") * F.col("docs")).alias("size")), mix
    )
    return source_tilts(counts, targets, mix)


def _rated(sized: DataFrame, tilts: DataFrame, mix: Mix) -> DataFrame:
    """``sized`` with what is sure of each document's copies, and its turn for another."""
    found = sized.join(tilts.withColumnRenamed("source", "s"), F.expr("source <=> s")).drop("s")
    rate = _rate(mix, F.col("tilt"), F.col("size"))
    full = F.col("target") >= F.col("source_size") * mix.most
    rate = F.when(F.col("size") == 0, 1.0).when(full, float(mix.most)).otherwise(rate)
    return (
        found.withColumn("rate", rate)
        .withColumn("floor", F.floor("rate"))
        .withColumn("queued", (F.col("size") > 0) & (F.col("floor") < mix.most))
        # A fraction f goes first where its place is below f.
        .withColumn("turn", F.col("place") - (F.col("rate") - F.col("floor")))
    )
