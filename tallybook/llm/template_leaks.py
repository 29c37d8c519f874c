"""Benchmark items in documents, also with other numbers, names and units.

A template is a text whose numbers, names and units are replaced by placeholders of their
type, which the form of a word alone decides: what begins with a capital is read as a name, and
plain windows, without regard to case, read it as the word it is. Windows of templates, and of the
plain words, are looked up in those of the benchmark. A match of templates counts if the slots
agree: one value of the item stands for one value of the document throughout, and the other way
round. Equal words in one stretch count by themselves.

Every window of the benchmark has an anchor, two of its words side by side that are no
placeholders, or one where no two are. Documents are only looked at around words that may be
anchors, which a table of bits tells; the candidates then meet the windows in an equi-join, whose
sides are plain rows, so that Spark can split a hot anchor.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.llm.shared import checkpointed, require_columns

# Words that are units of a measure, and the mark in front of a name.
UNITS = (
    "percent percentage mm cm m km inch inches foot feet yard yards mile miles g kg mg gram grams "
    "kilogram kilograms ton tons tonne tonnes pound pounds lb lbs ounce ounces oz ml l liter liters "
    "litre litres gallon gallons second seconds sec minute minutes min hour hours day days week "
    "weeks month months year years dollar dollars cent cents euro euros usd eur gbp yen degree "
    "degrees celsius fahrenheit kelvin meter meters metre metres kilometer kilometers kilometre "
    "kilometres watt watts kw kwh volt volts joule joules byte bytes kb mb gb tb hz khz mhz ghz "
    "mph kmh acre acres hectare hectares"
).split()
GAP = r"[\x20\x09-\x0D]+"
NO_WORD = r"[^\p{L}\p{N}\p{M}\x20\x09-\x0D]+"
#: The longest stretch of consecutive numbers in the sorted array ``same``.
STRETCH = """aggregate(
    same, struct(-2 AS last, 0 AS long, 0 AS most),
    (s, x) -> struct(
        x AS last, IF(x = s.last + 1, s.long + 1, 1) AS long,
        greatest(s.most, IF(x = s.last + 1, s.long + 1, 1)) AS most),
    s -> s.most)"""
#: Bits of the table of anchors for each of them, and the logarithm of its rows at most: 4 MB.
BITS_EACH, MOST_SLOTS = 256, 18


@dataclass(frozen=True)
class Leaks:
    """window: words of a window; an item with fewer is one window.

    words: how many words of an item, in one run of windows, make a leak, or all of a shorter
    item. literal: a window of a template with fewer words that are no placeholders is dense; it
    counts where a run holds the whole item only. shortest: items with fewer words have plain
    windows only, and a template that is shorter than a window needs ``short_literal`` words that
    are no placeholders.
    """

    window: int = 8
    words: int = 13
    literal: int = 4
    shortest: int = 5
    short_literal: int = 3

    def __post_init__(self) -> None:
        if not 1 <= self.short_literal <= self.shortest <= self.window or self.literal < 1:
            raise ValueError(f"not a set of limits: {self}")


def template_words(text: Column) -> Column:
    """Words without punctuation, as they are written; one empty word if there are none."""
    plain = F.regexp_replace(text, NO_WORD, "")
    return F.split(F.trim(plain, F.lit(" \t\n\x0b\x0c\r")), GAP)


def _typed(word: Column) -> Column:
    return (
        F.when(word.rlike(r"^\p{N}"), "<number>")
        .when(F.lower(word).isin(UNITS), "<unit>")
        .when(word.rlike(r"^\p{Lu}.*\p{Ll}"), "<name>")
        .otherwise(F.lower(word))
    )


def _is_literal(word: Column) -> Column:
    return ~_typed(word).startswith("<")


def _plain_hash(words: Column) -> Column:
    return F.xxhash64(F.lit("plain"), F.transform(words, F.lower))


def _template_hash(words: Column) -> Column:
    return F.xxhash64(F.lit("template"), F.transform(words, _typed))


def _anchor(literal: bool) -> Column:
    """(words, n, key, i) of the anchor of a window: the two words, or the word, with the most
    characters. With ``literal``, of those that are no placeholders; null if there are none."""

    def fits(*words: Column) -> Column:
        found = F.lit(True)
        for word in words if literal else ():
            found = found & _is_literal(word)
        return found

    def one(word: Column, i: Column) -> Column:
        key = F.xxhash64(F.lower(word))
        return F.when(
            fits(word),
            F.struct(F.lit(1).alias("words"), F.length(word).alias("n"), key.alias("key"), i.alias("i")),
        )

    def two(word: Column, i: Column) -> Column:
        then = F.get("words", i + 1)
        key = F.xxhash64(F.lower(word), F.lower(then))
        size = F.length(word) + F.length(then)
        return F.when(
            then.isNotNull() & fits(word, then),
            F.struct(F.lit(2).alias("words"), size.alias("n"), key.alias("key"), i.alias("i")),
        )

    return F.array_max(F.concat(F.transform("words", one), F.transform("words", two)))


def benchmark_windows(items: DataFrame, leaks: Leaks) -> DataFrame:
    """(key, offset, length, hash, plain, dense, item_id, at, words, item_words) of every window;
    ``key`` is the hash of its anchor and ``offset`` the anchor's place in it."""
    split = items.where("text is not null").select(
        "item_id", F.filter(template_words(F.col("text")), lambda w: w != "").alias("all")
    )
    cut = (
        split.withColumn("item_words", F.size("all"))
        .where("item_words > 0")
        .withColumn("length", F.least("item_words", F.lit(leaks.window)))
        .select(
            "item_id",
            "item_words",
            "length",
            F.posexplode(
                F.expr("transform(sequence(1, item_words - length + 1), i -> slice(all, i, length))")
            ).alias("at", "words"),
        )
        .withColumn("literals", F.size(F.filter("words", _is_literal)))
    )
    shared = ["length", "item_id", "item_words", "at", "words"]
    plain = cut.select(
        *shared, _anchor(False).alias("anchor"), _plain_hash(F.col("words")).alias("hash"),
        F.lit(True).alias("plain"), F.lit(False).alias("dense"),
    )
    least = F.when(F.col("item_words") < leaks.window, leaks.short_literal).otherwise(1)
    templates = cut.where(
        (F.col("item_words") >= leaks.shortest)
        & (F.col("literals") < F.col("length"))
        & (F.col("literals") >= least)
    ).select(
        *shared, _anchor(True).alias("anchor"), _template_hash(F.col("words")).alias("hash"),
        F.lit(False).alias("plain"), (F.col("literals") < leaks.literal).alias("dense"),
    )
    return plain.unionByName(templates).select(
        F.col("anchor.key").alias("key"), F.col("anchor.i").alias("offset"), "hash", "plain", "dense", *shared,
    )


def _bits(windows: DataFrame) -> tuple[DataFrame, int]:
    """(slot, bits) and k, where slots have k bits: a bit is set for the key of each anchor.

    The high bits of a key choose the slot and the low ones the bit. The table grows with the
    anchors up to 2^MOST_SLOTS rows; beyond, more words that are no anchors pass and are joined
    in vain.
    """
    keys = windows.select("key").distinct()
    wanted, slots = BITS_EACH * keys.count(), 0
    while slots < MOST_SLOTS and 64 << slots < wanted:
        slots += 1
    bits = keys.groupBy(_slot(slots).alias("slot")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(key & 63 AS INT))")).alias("bits")
    )
    return checkpointed(bits), slots


def _slot(slots: int) -> Column:
    return F.shiftrightunsigned("key", 64 - slots) if slots else F.lit(0).cast("long")


def find_leaks(docs: DataFrame, items: DataFrame, leaks: Leaks = Leaks()) -> DataFrame:
    """(doc_id, text_hash, item_id, n_words, item_words, exact) of every leak.

    ``n_words`` counts the words of the item that the document holds in one run, and ``exact``
    says that they are the same words. ``text_hash`` is the xxhash64 of the document's text, to
    tell rows with equal or null ids apart. Null and empty texts leak nothing, items without
    words are in nothing, and of those of fewer than ``leaks.shortest`` words, as of windows
    without a word that is no placeholder, only the same words are found. Rows that repeat count
    once, a null item_id is one item, and an empty table on either side gives no rows. Other
    columns are ignored.
    """
    require_columns(docs, "doc_id", "text")
    require_columns(items, "item_id", "text")
    windows = checkpointed(benchmark_windows(items.select("item_id", "text").distinct(), leaks))
    bits, slots = _bits(windows)
    side = leaks.window - 1
    pad = F.array_repeat(F.lit(""), side)
    # All single words, then all words with the next one. No lambda looks into an array that it
    # runs through: Spark may compute that array for each of its elements.
    keys = F.expr(
        "concat(transform(all, w -> xxhash64(lower(w))),"
        " zip_with(all, slice(all, 2, size(all)), (w, v) -> xxhash64(lower(w), lower(v))))"
    )
    # How many words a side of the anchor takes is fixed, so it begins in the middle.
    around = (
        docs.where("text is not null")
        .select("doc_id", F.xxhash64("text").alias("text_hash"), template_words(F.col("text")).alias("all"))
        .select(
            "doc_id", "text_hash", F.concat(pad, F.col("all"), pad).alias("padded"),
            F.coalesce(F.size("all"), F.lit(0)).alias("n"), keys.alias("keys"),
        )
        # The outer form and the coalesce: else Spark adds filters that compute all this twice.
        .select("doc_id", "text_hash", "padded", "n", F.posexplode_outer("keys").alias("i", "key"))
        .withColumn("slot", _slot(slots))
        # 2^MOST_SLOTS rows at most, whatever the benchmark's size.
        .join(F.broadcast(bits), "slot")
        .where("getbit(bits, CAST(key & 63 AS INT)) = 1")
        .select(
            "doc_id", "text_hash", "key", F.expr("i % n").alias("place"),
            F.slice("padded", F.expr("i % n + 1"), 2 * side + 1).alias("around"),
        )
    )
    met = around.join(windows, "key")
    doc_side = F.slice("around", F.lit(side + 1) - F.col("offset"), F.col("length"))
    same = F.when(F.col("plain"), _plain_hash(F.col("doc_side"))).otherwise(
        _template_hash(F.col("doc_side"))
    )
    matched = (
        met.withColumn("doc_side", doc_side)
        .where(same == F.col("hash"))
        .select(
            "doc_id", "text_hash", "item_id", "item_words", "at", "length", "plain", "dense",
            # Windows of one run keep their distance from those of the item.
            (F.col("place") - F.col("offset") - F.col("at")).alias("shift"),
            F.col("words").alias("item_side"), "doc_side",
        )
    )
    matched = checkpointed(matched)
    run = ["doc_id", "text_hash", "item_id", "item_words", "shift"]

    def covered(condition: str) -> Column:
        """The places of the item that windows of this kind cover."""
        places = F.expr(f"IF({condition}, sequence(at, at + length - 1), NULL)")
        return F.array_distinct(F.flatten(F.collect_set(places)))

    runs = matched.groupBy(*run).agg(
        F.size(covered("NOT dense")).alias("n_words"),
        F.size(covered("true")).alias("n_all"),
        F.array_sort(covered("plain")).alias("same"),
    )
    runs = runs.withColumn("same_words", F.size("same")).withColumn("stretch", F.expr(STRETCH)).drop("same")
    clashing = _clashing_slots(matched, run)
    key = [F.expr(f"{c} <=> c_{c}") for c in run]
    on = key[0]
    for part in key[1:]:
        on &= part
    judged = runs.join(
        clashing.select(*[F.col(c).alias(f"c_{c}") for c in run], F.lit(True).alias("clash")), on, "left"
    )
    # Slots that clash speak against the templates of a run, not against its equal words.
    held = judged.withColumns(
        {
            c: F.when(F.col("clash"), F.col("stretch")).otherwise(F.col(c))
            for c in ("n_words", "n_all", "same_words")
        }
    ).withColumn(
        # Dense windows count where the whole item is there.
        "n_words", F.when(F.col("n_all") == F.col("item_words"), F.col("n_all")).otherwise(F.col("n_words"))
    )
    return (
        held.where(F.col("n_words") >= F.least("item_words", F.lit(leaks.words)))
        .groupBy("doc_id", "text_hash", "item_id", "item_words")
        .agg(
            F.max("n_words").alias("n_words"),
            F.bool_or(F.col("n_words") == F.col("same_words")).alias("exact"),
        )
        .select("doc_id", "text_hash", "item_id", "n_words", "item_words", "exact")
    )


def _clashing_slots(matched: DataFrame, run: list[str]) -> DataFrame:
    """Runs in which a value of the item stands for two of the document, or two for one."""
    slots = (
        matched.where("not plain")
        .select(*run, F.explode(F.arrays_zip("item_side", "doc_side")).alias("s"))
        .withColumn("kind", _typed(F.col("s.item_side")))
        .where(F.col("kind").startswith("<"))
        .select(
            *run, "kind", F.lower("s.item_side").alias("mine"), F.lower("s.doc_side").alias("other")
        )
        .distinct()
    )
    two = slots.groupBy(*run, "kind", "mine").count().unionByName(
        slots.groupBy(*run, "kind", F.col("other").alias("mine")).count()
    )
    return two.where("count > 1").select(*run).distinct()


def without_leaks(docs: DataFrame, items: DataFrame, leaks: Leaks = Leaks()) -> DataFrame:
    """The documents, with all their columns, whatever their names, that hold no item of the
    benchmark. Odd rows are as in ``find_leaks``: a document without a text stays."""
    found = find_leaks(docs, items, leaks).select(
        F.col("doc_id").alias("leak"), F.col("text_hash").alias("leak_hash")
    )
    # In one struct, the given columns clash with nothing.
    given = docs.select(F.struct("*").alias("given"))
    return given.join(
        found.distinct(),
        F.expr("given.doc_id <=> leak AND xxhash64(given.text) = leak_hash"),
        "left_anti",
    ).select("given.*")
