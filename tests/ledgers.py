"""Small ledgers written as tuples, for Spark and for DuckDB alike."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

from tallybook import schema
from tallybook.operators import build_section_balance
from tallybook.sources import Ledger

TABLES = {
    "account": schema.ACCOUNT,
    "statement_section": schema.STATEMENT_SECTION,
    "journal_entry": schema.JOURNAL_ENTRY,
    "journal_entry_line_item": schema.JOURNAL_ENTRY_LINE_ITEM,
}


def frame(spark, columns, rows):
    return spark.createDataFrame(rows, T._parse_datatype_string(schema.ddl(columns)))


@dataclass
class Book:
    """Rows in the column order of the schemas."""

    account: list = field(default_factory=list)
    statement_section: list = field(default_factory=list)
    journal_entry: list = field(default_factory=list)
    journal_entry_line_item: list = field(default_factory=list)

    def ledger(self, spark) -> Ledger:
        tables = {name: frame(spark, cols, getattr(self, name)) for name, cols in TABLES.items()}
        return Ledger(
            account=tables["account"],
            section=tables["statement_section"],
            entry=tables["journal_entry"],
            line=tables["journal_entry_line_item"],
        )

    def load(self, con) -> None:
        for name, columns in TABLES.items():
            con.execute(f"CREATE OR REPLACE TABLE {name} ({schema.ddl(columns)})")
            rows = getattr(self, name)
            if rows:
                marks = ", ".join("?" for _ in columns)
                con.executemany(f"INSERT INTO {name} VALUES ({marks})", rows)


def book(sections, accounts, postings, cancelled=()) -> Book:
    """Postings are (entry date, account, debit, credit), one entry each.

    ``cancelled`` holds the positions of cancelled postings.
    """
    return Book(
        account=list(accounts),
        statement_section=list(sections),
        journal_entry=[(i, p[0], int(i in cancelled)) for i, p in enumerate(postings)],
        journal_entry_line_item=[(i, *p[1:]) for i, p in enumerate(postings)],
    )


def mart_rows(spark, book: Book):
    rows = build_section_balance(book.ledger(spark)).collect()
    return sorted((tuple(r) for r in rows), key=repr)


def mart(spark, rows):
    """A section-balance table from (flag, company, year, order, label, balance)."""
    return frame(spark, schema.SECTION_BALANCE, rows)
