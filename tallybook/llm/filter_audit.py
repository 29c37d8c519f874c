"""What a chain of filters removes, for every order of them, and each filter's fair share.

Which filters a document fails is a pattern of bits, and all that the audit says is told by the
number of documents of each pattern: coalition S removes the documents whose pattern meets S, and
a filter that comes after the coalition S removes what S with it removes more than S alone.

The share of a filter is its Shapley value. It is the solution of a least-squares problem over all
coalitions, weighted by the Shapley kernel, under the constraint that the shares add up to what
all filters remove. Its normal equations do not depend on the data, so they are solved once, in
rationals, for every right-hand side: the shares are fixed sums of the coalitions' removals.

The corpus is read once for the patterns. Telling the first document of each text from its copies
takes a shuffle of hashes and ids, not of texts, in which copies of one text are apart.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from fractions import Fraction
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.llm.shared import require_columns

WORD_GAP = r"[\x20\x09-\x0D]+"
#: More filters would have too many orders to list: 6 have 720.
MOST_FILTERS = 6


def shapley_coefficients(n: int) -> list[list[Fraction]]:
    """Row i, column S: how much the removals of coalition S, a bit mask, count in share i.

    With z the coalitions but the empty and the full one as 0/1 rows, W their kernel weights, v
    their values and 1 a vector of ones, the shares x minimise (v - z x)' W (v - z x) under
    1'x = v(full). That is [z'Wz 1; 1' 0] [x; l] = [z'W v; v(full)], solved by elimination with
    one right-hand side for each coalition.
    """
    full = (1 << n) - 1
    members = [[i for i in range(n) if s >> i & 1] for s in range(full + 1)]
    rows = [[Fraction(0)] * (n + 1 + full + 1) for _ in range(n + 1)]
    for s in range(1, full):
        size = len(members[s])
        weight = Fraction(n - 1, math.comb(n, size) * size * (n - size))
        for i in members[s]:
            for j in members[s]:
                rows[i][j] += weight
            rows[i][n + 1 + s] += weight
    for i in range(n):
        rows[i][n] = rows[n][i] = Fraction(1)
    rows[n][n + 1 + full] = Fraction(1)
    for k in range(n + 1):
        pivot = next(r for r in range(k, n + 1) if rows[r][k])
        rows[k], rows[pivot] = rows[pivot], rows[k]
        rows[k] = [x / rows[k][k] for x in rows[k]]
        for r in range(n + 1):
            if r != k and rows[r][k]:
                factor = rows[r][k]
                rows[r] = [x - factor * y for x, y in zip(rows[r], rows[k], strict=True)]
    return [row[n + 1 :] for row in rows[:n]]


#: True where a document fails, in terms of its text and its words; a null text is empty.
TEXT_FILTERS = {
    "A": "size(words) < 200",
    "B": "100 * size(array_distinct(words)) < 50 * size(words)",
    "C": "100 * regexp_count(text, '[A-Z]') > 2 * length(text)",
    "D": "text rlike '[#$%&*|]'",
}


def failure_patterns(
    docs: DataFrame,
    labels: DataFrame,
    failures: Mapping[str, str] = TEXT_FILTERS,
    repeat: str | None = None,
    part: str = "source",
) -> DataFrame:
    """(part, pattern, docs, good, toxic): how many documents fail which filters.

    Bit i of ``pattern`` is the i-th of ``failures``, SQL text over ``text`` and the array ``words``;
    the last bit is the filter ``repeat``, if named: a document fails it if one with a smaller
    doc_id has the same text, in any part and whatever became of it. Texts are told apart by 128
    bits. A document without an id is no one's first and no one's copy, and rows that repeat both
    id and text are not copies of each other. ``good`` and ``toxic`` count the
    documents that a row of ``labels`` marks so; rows of ``labels`` may repeat.
    """
    require_columns(docs, "doc_id", "text", part)
    require_columns(labels, "doc_id", "quality", "toxic")
    pattern = " + ".join(f"IF({bad}, {1 << i}, 0)" for i, bad in enumerate(failures.values()))
    marked = labels.groupBy("doc_id").agg(
        F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
    )
    text = F.coalesce("text", F.lit(""))
    hashes = [F.xxhash64("text").alias("text_1"), F.xxhash64(F.lit(1), "text").alias("text_2")]
    slim = (
        docs.select(
            "doc_id", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
            text.alias("text"), F.filter(F.split(text, WORD_GAP), lambda w: w != "").alias("words"),
        )
        .select("doc_id", "part", F.expr(pattern).alias("pattern"), *(hashes if repeat else ()))
    )
    keys = ["text_1", "text_2", "doc_id"] if repeat else ["doc_id"]
    # Rows that repeat are counted before anything is joined to them.
    facts = slim.groupBy(*keys, "part", "pattern").agg(F.count(F.lit(1)).alias("docs"))
    if repeat:
        first = facts.groupBy("text_1", "text_2").agg(F.min("doc_id").alias("doc_id"))
        # By text and id, so that copies of one text do not meet in one task.
        named = first.where("doc_id is not null").withColumn("is_first", F.lit(True))
        copy = F.col("doc_id").isNotNull() & F.col("is_first").isNull()
        facts = facts.join(named, keys, "left").withColumn(
            "pattern", F.col("pattern") + F.when(copy, F.lit(1 << len(failures))).otherwise(0)
        )
    facts = facts.join(marked, "doc_id", "left")
    return facts.groupBy("part", "pattern").agg(
        F.sum("docs").alias("docs"),
        F.coalesce(F.sum(F.when(F.col("good"), F.col("docs"))), F.lit(0)).alias("good"),
        F.coalesce(F.sum(F.when(F.col("toxic"), F.col("docs"))), F.lit(0)).alias("toxic"),
    )


def audit(patterns: DataFrame, filters: Sequence[str]) -> DataFrame:
    """A row per part, order of the filters and step, from what ``failure_patterns`` counts.

    (part, filter_order, step, filter, kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley). ``shapley`` is the filter's ``removed`` summed over all orders, which is
    its Shapley value times their number. Filters are single letters. A part without documents
    has no rows; one whose documents fail nothing has zeros.
    """
    n = len(filters)
    if not 2 <= n <= MOST_FILTERS or len(set("".join(filters))) != n:
        raise ValueError(f"two to {MOST_FILTERS} different letters are needed: {filters}")
    size = 1 << n

    def at(column: str, pattern: int) -> Column:
        found = F.sum(F.when(F.col("pattern") == pattern, F.col(column)))
        return F.coalesce(found, F.lit(0)).cast("long")

    def removals(column: str) -> Column:
        """What each coalition removes: the patterns that meet it."""
        met = f"aggregate(sequence(0, {size - 1}), 0L, (a, p) -> a + IF((p & s) != 0, {column}[p], 0L))"
        return F.expr(f"transform(sequence(0, {size - 1}), s -> {met})").alias(f"{column}_lost")

    names = ("docs", "good", "toxic")
    tables = patterns.groupBy("part").agg(
        *[F.array(*[at(name, p) for p in range(size)]).alias(name) for name in names]
    )
    removed = tables.select("part", "docs", *[removals(name) for name in names])
    orders = math.factorial(n)
    shares = []
    for row in shapley_coefficients(n):
        # Over all orders together the coefficients are whole numbers.
        shares.append(" + ".join(f"{int(c * orders)}L * docs_lost[{s}]" for s, c in enumerate(row) if c))
    removed = removed.withColumn("shares", F.expr(f"array({', '.join(shares)})"))
    letters = "".join(filters)
    listed = " ".join("".join(order) for order in permutations(letters))
    steps = (
        removed.withColumn("filter_order", F.explode(F.split(F.lit(listed), " ")))
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(n))))
        .withColumn("filter", F.expr("substring(filter_order, step, 1)"))
        .withColumn("i", F.expr(f"instr('{letters}', filter) - 1"))
        .withColumn("own", F.expr("shiftleft(1, i)"))
        .withColumn(
            "before",
            F.expr(
                "aggregate(sequence(1, step), 0, (a, k) -> a + IF(k < step, "
                f"shiftleft(1, instr('{letters}', substring(filter_order, k, 1)) - 1), 0))"
            ),
        )
    )

    def lost(name: str) -> str:
        return f"{name}_lost[before + own] - {name}_lost[before]"

    return steps.selectExpr(
        "part", "filter_order", "step", "filter",
        "aggregate(docs, 0L, (a, x) -> a + x) - docs_lost[before + own] AS kept",
        f"{lost('docs')} AS removed",
        f"docs_lost[own] - ({lost('docs')}) AS redundant",
        "docs[own] AS unique_fails",
        f"{lost('good')} AS good_lost",
        f"{lost('toxic')} AS toxic_lost",
        "shares[i] AS shapley",
    )


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five filters A to E over ``documents``.

    A: under 200 words. B: fewer than half of the words are different. C: over 2 % capitals. D: a
    character of #$%&*|. E: a copy. Null texts are empty and fail A; a null source is the part of
    the empty string. Other columns are ignored, and an empty table gives no rows.
    """
    return audit(failure_patterns(docs, labels, TEXT_FILTERS, repeat="E"), [*TEXT_FILTERS, "E"])
