"""A journal stored so that one company or one year reads a small part of it.

Lines carry the header of their entry, so reports need no join, and lie along a Z-order curve over
(company, date): a file holds a small rectangle of companies and dates, whose bounds stand in the
statistics of its row groups. A filter on the company, on the dates or on both leaves out most
files and row groups, where a sort by one of them serves that one only. Bloom filters on the ids
serve the look-up of one entry or account.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallybook.sources.ledger import Ledger

#: Bits of each coordinate: companies and dates are told apart in 2^BITS steps of their range.
BITS = 12
#: The company that a line is filed under; NULL where it may be of several, or of none.
FILED_UNDER = "filed_under"


def save_clustered_journal(
    ledger: Ledger,
    path: str,
    files: int,
    bloom_filters: Sequence[str] = ("journal_entry_id", "account_id"),
    row_group_bytes: int | None = None,
) -> None:
    """Write the lines with their headers to ``path`` as about ``files`` Parquet files.

    Lines without an entry post nothing and are left out. Cancelled entries and entries without a
    date stay, the latter before all others. A company or a day with a large share of the lines
    is cut by entry, and an entry by line, so files are about equal whatever the lines are.

    Lines are filed under ``Ledger.line_company`` or under the company of their account's
    sections, as these are now. A copy written before an account got a section of another company
    has to be written again.
    """
    if files < 1:
        raise ValueError(f"files is {files}")
    # Equal lines must not stay together, so the place of a line in its task decides, too.
    place = F.xxhash64(*ledger.line.columns, F.monotonically_increasing_id())
    lines = _filed(ledger).withColumn("place", place)
    headers = ledger.entry.select(*ledger.entry_keys, "entry_date", "cancelled")
    rows = lines.join(headers, list(ledger.entry_keys))
    filed = ledger.line.select(F.expr(ledger.line_company).alias("c")) if ledger.line_company else (
        ledger.section.select(F.col("company_id").alias("c"))
    )
    low, high = filed.agg(F.min("c"), F.max("c")).first()
    first, last = ledger.entry.agg(F.min("entry_date"), F.max("entry_date")).first()
    company = _step(FILED_UNDER, low, high)
    day = _step(
        "datediff(entry_date, DATE'1970-01-01')",
        first and first.toordinal() - 719163,
        last and last.toordinal() - 719163,
    )
    curve = " + ".join(
        f"shiftleft(shiftright({x}, {i}) & 1, {2 * i + shift})"
        for i in range(BITS)
        for shift, x in enumerate(("x", "y"))
    )
    order = ["curve", "journal_entry_id", "place"]
    writer = (
        rows.withColumns({"x": F.expr(company), "y": F.expr(day)})
        .withColumn("curve", F.expr(curve))
        .drop("x", "y")
        .repartitionByRange(files, *order)
        .sortWithinPartitions(*order)
        .drop("curve", "place")
        .write.mode("overwrite")
    )
    for name in bloom_filters:
        if name in rows.columns:
            writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true")
    if row_group_bytes is not None:
        writer = writer.option("parquet.block.size", row_group_bytes)
    writer.parquet(path)


def ledger_from_clustered(spark: SparkSession, rest: Ledger, path: str) -> Ledger:
    """The ledger whose journal ``save_clustered_journal`` has written.

    Accounts, sections and how rows are expanded are those of ``rest``. ``entry`` has the headers
    of entries with lines; the reports do not read it.
    """
    line = spark.read.parquet(path)
    return Ledger(
        account=rest.account,
        section=rest.section,
        entry=line.select("journal_entry_id", "entry_date", "cancelled").distinct(),
        line=line,
        expand=rest.expand,
        line_company=FILED_UNDER,
        headers_on_lines=True,
    )


def _filed(ledger: Ledger) -> DataFrame:
    """The lines with the company that they are filed under."""
    if ledger.headers_on_lines:
        raise ValueError("this journal has its headers on its lines already")
    if ledger.line_company is not None:
        return ledger.line.withColumn(FILED_UNDER, F.expr(f"CAST({ledger.line_company} AS INT)"))
    if ledger.expand is not None:
        return ledger.line.withColumn(FILED_UNDER, F.lit(None).cast("int"))
    one = "IF(min(company_id) = max(company_id), min(company_id), NULL)"
    companies = (
        ledger.account.selectExpr(
            "account_id",
            "explode(array(profit_loss_section_id, balance_sheet_section_id)) "
            "AS statement_section_id",
        )
        .join(ledger.section, "statement_section_id")
        .groupBy("account_id")
        .agg(F.expr(f"{one} AS {FILED_UNDER}"))
    )
    return ledger.line.join(companies, "account_id", "left")


def _step(value: str, low: int | None, high: int | None) -> str:
    """The position of a value in its range, in 2^BITS steps; NULL is the first."""
    if low is None:
        return "0L"
    last = (1 << BITS) - 1
    scaled = f"CAST({value} - {low} AS DOUBLE) / {max(high - low, 1)} * {last}"
    return f"coalesce(least(greatest(CAST({scaled} AS BIGINT), 0L), {last}L), 0L)"
