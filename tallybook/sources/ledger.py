"""The four ledger tables as one argument."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallybook import schema


@dataclass(frozen=True)
class Ledger:
    """A double-entry journal with its accounts and statement sections.

    ``line`` normally has one row per posting. A journal stored with several postings
    per row passes those rows as ``line`` (they need ``journal_entry_id``) and
    ``expand``, which turns them into one row per posting and keeps any other column.
    The rows are then joined to their entries before they are expanded, so the large
    join moves the compact rows.

    ``line_company`` is SQL text for the company of a row of ``line``, where the row alone
    tells it, for instance by the column that the journal is partitioned by; NULL where it does
    not. Reports for one company then leave the other rows out before the large join.

    With ``headers_on_lines``, the rows of ``line`` have entry_date and cancelled themselves, as
    ``save_clustered_journal`` writes them. The reports then need no join and do not read ``entry``.

    ``gather`` names a column of ``line``, for journals with so many accounts that a task of the
    large join meets most of its accounts once: there a partial sum holds a group for almost every
    posting and saves the shuffle little. Rows that are alike in that column, such as those of a
    supplier, should post to the same few accounts. The joined rows are then brought together by
    it, before they are expanded and summed, and tasks hold the sums of few accounts. Accounts and
    sections, as many then, are shuffled to the sums and not broadcast. Entries, as many, are hashed
    by the partition for the large join, see ``hashed``.
    """

    account: DataFrame
    section: DataFrame
    entry: DataFrame
    line: DataFrame
    expand: Callable[[DataFrame], DataFrame] | None = None
    line_company: str | None = None
    entry_keys: tuple[str, ...] = ("journal_entry_id",)
    headers_on_lines: bool = False
    gather: str | None = None

    def lines_of(self, company_id: int | None) -> DataFrame:
        """The rows of ``line`` that a company may have; all if they do not tell."""
        if company_id is None:
            return self.line
        if self.line_company is not None:
            of_row = f"({self.line_company})"
            return self.line.where(f"{of_row} = {int(company_id)} OR {of_row} IS NULL")
        if self.expand is not None:
            return self.line
        # Few accounts are a company's, so this is a broadcast unless Spark finds them too many.
        links = self.account.selectExpr(
            "account_id",
            "explode(array(profit_loss_section_id, balance_sheet_section_id)) "
            "AS statement_section_id",
        )
        sections = self.section.where(f"company_id = {int(company_id)}")
        accounts = links.join(sections, "statement_section_id", "left_semi")
        return self.line.join(accounts, "account_id", "left_semi")

    def hashed(self, entry: DataFrame) -> DataFrame:
        """Entries for the large join: with ``gather``, each task hashes those of its partition.

        Lines then pass by and are not sorted, which else takes most of a task's memory. A hash
        table does not spill, but has two or three numbers an entry. Buckets, which no shuffle cuts
        to size, keep the join that Spark picks.
        """
        in_buckets = self.entry_keys != ("journal_entry_id",)
        return entry if self.gather is None or in_buckets else entry.hint("shuffle_hash")

    def gathered(self, lines: DataFrame) -> DataFrame:
        """Joined rows of ``line``, brought together by ``gather``; a hot value has several tasks."""
        return lines if self.gather is None else lines.hint("rebalance", self.gather)

    def postings(self, lines: DataFrame) -> DataFrame:
        return lines if self.expand is None else self.expand(lines)

    def line_items(self) -> DataFrame:
        """One row per posting: journal_entry_id, account_id, debit, credit."""
        return schema.conform(self.postings(self.line), schema.JOURNAL_ENTRY_LINE_ITEM)


def ledger_from_reader(read: Callable[[str], DataFrame]) -> Ledger:
    """Read the four tables with ``read(name)``, for instance over JDBC.

    A JDBC reader should split the two journal tables by ``journal_entry_id``
    (``column``, ``lowerBound``, ``upperBound``, ``numPartitions``).
    """
    entry = read("journal_entry")
    return Ledger(
        account=schema.conform(read("account"), schema.ACCOUNT),
        section=schema.conform(read("statement_section"), schema.STATEMENT_SECTION),
        entry=schema.conform(entry, schema.with_stored_flag(entry, schema.JOURNAL_ENTRY)),
        line=schema.conform(read("journal_entry_line_item"), schema.JOURNAL_ENTRY_LINE_ITEM),
    )


def ledger_from_tables(
    spark: SparkSession, database: str | None = None, **tables: str
) -> Ledger:
    """Read the four catalog tables of ``database`` (default: the current one).

    A table that lives elsewhere is named by keyword:
    ``ledger_from_tables(spark, "books", account="master.account")``.
    """
    prefix = "" if database is None else f"{database}."
    return ledger_from_reader(lambda name: spark.table(tables.get(name, prefix + name)))


def ledger_from_files(spark: SparkSession, path: str, fmt: str = "parquet") -> Ledger:
    """Read ``path/<table>`` for the four tables, e.g. Parquet or ORC directories."""
    return ledger_from_reader(lambda name: spark.read.format(fmt).load(f"{path}/{name}"))


_SECTIONS = ("statement_section_id", "profit_loss_section_id", "balance_sheet_section_id")
_IDS = (*_SECTIONS, "account_id", "journal_entry_id")
_ID_BITS = 47


def merge_ledgers(ledgers: Mapping[int, Ledger]) -> Ledger:
    """One ledger out of several databases, each with a number of its own from 0 to 65,535.

    Ids are kept apart by that number in the bits above them, so ids of one database may be
    those of another; an id of more than 47 bits raises. The section id 0, which means none,
    stays 0. Companies are one and the same where their ids are.
    """
    if not ledgers:
        raise ValueError("no ledgers to merge")
    for number, ledger in ledgers.items():
        if not 0 <= number < 1 << 16:
            raise ValueError(f"a database number is out of range: {number}")
        if ledger.headers_on_lines:
            raise ValueError("merge ledgers before their headers are put on their lines")
        if ledger.entry_keys != ("journal_entry_id",):
            raise ValueError("merge ledgers before their entries are cut into parts")
        if ledger.expand is not None:
            raise ValueError("expand the lines of a ledger before it is merged")

    def moved(name: str, number: int) -> str:
        outside = f"raise_error('an id needs over {_ID_BITS} bits')"
        new = f"IF({name} BETWEEN 0 AND {(1 << _ID_BITS) - 1}, {name} + {number << _ID_BITS}L, {outside})"
        kept = f"{name} IS NULL" + (f" OR {name} = 0" if name in _SECTIONS else "")
        return f"IF({kept}, {name}, {new})"

    def tagged(df: DataFrame, number: int) -> DataFrame:
        return df.withColumns(
            {name: F.expr(moved(name, number)) for name in _IDS if name in df.columns}
        )

    def merged(part: str) -> DataFrame:
        parts = [tagged(getattr(ledger, part), number) for number, ledger in ledgers.items()]
        return reduce(DataFrame.unionByName, parts)

    return Ledger(merged("account"), merged("section"), merged("entry"), merged("line"))
