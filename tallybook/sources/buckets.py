"""A journal in buckets that joins without a shuffle, also where one entry has a share of all lines.

Lines and entries are bucketed by (journal_entry_id, part). Most entries are one part, 0. An entry
with more lines than a part may have is spread over several, evenly, whatever its lines are, and
its header stands in each of them. So no bucket is much larger than the others, and the join of
both tables on both columns needs no exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallybook import schema
from tallybook.sources.ledger import Ledger

#: What entries and lines are bucketed by and joined on.
PART_KEYS = ("journal_entry_id", "part")
#: Parts of an average bucket: a large part makes a bucket larger by this share of the average.
PARTS_OF_A_BUCKET = 8


def save_bucketed_journal(
    ledger: Ledger, entry_table: str, line_table: str, buckets: int, path: str | None = None
) -> int:
    """Write the journal as two catalog tables, and return the lines that a part may have.

    ``path`` is a folder for the files, the warehouse by default. Lines without an entry id post
    nothing and are left out. One pass counts the lines of every entry; what is kept of it are the
    entries of several parts, ``PARTS_OF_A_BUCKET * buckets`` of them at most.
    """
    if buckets < 1:
        raise ValueError(f"buckets is {buckets}")
    if ledger.headers_on_lines:
        raise ValueError("the headers are on the lines: there is nothing to join")
    lines = ledger.line.where("journal_entry_id IS NOT NULL")
    counted = lines.groupBy("journal_entry_id").agg(F.count(F.lit(1)).alias("n"))
    total = lines.count()
    most = max(1, -(-total // (PARTS_OF_A_BUCKET * buckets)))
    parts = counted.where(F.col("n") > most).select(
        "journal_entry_id", F.expr(f"CAST(ceil(n / {most}) AS INT)").alias("parts")
    )
    # Equal lines must not stay together, so the place of a line in its task decides, too.
    place = F.xxhash64(*lines.columns, F.monotonically_increasing_id())
    spread = (
        lines.withColumn("place", place)
        # So many rows at most, see above.
        .join(F.broadcast(parts), "journal_entry_id", "left")
        .withColumn("part", F.expr("CAST(pmod(place, coalesce(parts, 1)) AS INT)"))
        .drop("place", "parts")
    )
    headers = ledger.entry.join(F.broadcast(parts), "journal_entry_id", "left").select(
        *ledger.entry.columns, F.explode(F.expr("sequence(0, coalesce(parts, 1) - 1)")).alias("part")
    )
    for df, table in ((headers, entry_table), (spread, line_table)):
        _save(df, table, buckets, path)
    return most


def _save(df: DataFrame, table: str, buckets: int, path: str | None) -> None:
    # Dealt as the buckets are, each bucket is one file, and sorted.
    writer = (
        df.repartition(buckets, *PART_KEYS)
        .write.mode("overwrite")
        .bucketBy(buckets, *PART_KEYS)
        .sortBy(*PART_KEYS)
        .format("parquet")
    )
    if path is not None:
        writer = writer.option("path", f"{path}/{table.rpartition('.')[2]}")
    writer.saveAsTable(table)


def ledger_from_buckets(
    spark: SparkSession, rest: Ledger, entry_table: str, line_table: str
) -> Ledger:
    """The ledger whose journal ``save_bucketed_journal`` has written.

    Accounts, sections and how rows are expanded are those of ``rest``.
    """
    entry, line = spark.table(entry_table), spark.table(line_table)
    schema.conform(entry, {"part": "int"} | schema.with_stored_flag(entry, schema.JOURNAL_ENTRY))
    return Ledger(
        rest.account,
        rest.section,
        entry,
        line,
        rest.expand,
        rest.line_company,
        PART_KEYS,
        gather=rest.gather,
    )
