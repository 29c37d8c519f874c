"""Section balances kept up to date from changes, without another look at the journal.

What is kept is the sum of every account and year with the number of lines behind it. A change is
what some lines and entries were and what they are: the old postings are taken back and the new
ones added, in one aggregation whose size is that of the change. Merged by key, sums and counts of
any sequence of changes are those of a rebuild, a group whose last line has gone disappears, and a
side without any amount is NULL again. Balances follow from the kept sums, which are accounts x
years rows, so that new links or sections of an account need no journal either.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallybook.chart import STANDARD, Chart
from tallybook.functions import exact_sum
from tallybook.operators.balances import balances_of_totals, posted_lines, require_ansi
from tallybook.schema import AMOUNT
from tallybook.sources.ledger import Ledger

#: What is kept for an account and a year: sums, and how many lines and amounts are in them.
KEPT = ("account_id", "year", "debit", "credit", "n_lines", "n_debits", "n_credits")


def _signed(posted: DataFrame, sign: int) -> DataFrame:
    side = "-{0}" if sign < 0 else "{0}"
    return posted.selectExpr(
        "account_id",
        "year",
        *[f"{side.format(s)} AS {s}" for s in ("debit", "credit")],
        f"CAST({sign} AS BIGINT) AS weight",
    )


def _counted(signed: DataFrame) -> DataFrame:
    """Sums of amounts that carry their sign, and of the weights of their lines."""
    require_ansi(signed.sparkSession)
    types = dict(signed.dtypes)
    sums = [
        F.expr(exact_sum(side) if types[side] == AMOUNT else f"sum({side})").alias(side)
        for side in ("debit", "credit")
    ]
    counts = [
        F.expr(f"coalesce(sum(weight) FILTER (WHERE {side} IS NOT NULL), 0)").alias(f"n_{side}s")
        for side in ("debit", "credit")
    ]
    return signed.groupBy("account_id", "year").agg(
        *sums, F.sum("weight").alias("n_lines"), *counts
    ).select(*KEPT)


def kept_totals(ledger: Ledger) -> DataFrame:
    """The totals of a whole ledger: what a first load stores and changes are merged into."""
    return _counted(_signed(posted_lines(ledger), 1))


def change_totals(before: Ledger, after: Ledger) -> DataFrame:
    """What a change adds to the kept totals; sums and counts may be negative.

    Both ledgers hold only the entries and lines that the change touches, as they were and as
    they are; accounts and sections are not read. A new entry is in ``after`` alone, a deleted
    one in ``before`` alone. An entry that is cancelled or gets another date comes with all its
    lines on both sides; a line that changes comes alone, with its entry. Lines of entries that
    are cancelled, or not there, do not count, on either side.
    """
    old, new = _signed(posted_lines(before), -1), _signed(posted_lines(after), 1)
    return _counted(new.unionByName(old))


def merge_totals(kept: DataFrame, *changes: DataFrame) -> DataFrame:
    """The kept totals after some changes, in any order; groups without lines are gone.

    One shuffle of rows by account and year. A change that takes back more lines or amounts than
    there are raises: it was applied twice, or to other totals.
    """
    merged = kept
    for change in changes:
        merged = merged.unionByName(change)
    sums = [F.sum(name).alias(name) for name in KEPT[2:]]
    summed = merged.groupBy("account_id", "year").agg(*sums)
    wrong = "concat('more was taken back than there is: account ', account_id, ', year ', year)"
    sound = f"IF(least(n_lines, n_debits, n_credits) < 0, raise_error({wrong}), n_lines)"
    return summed.selectExpr(
        "account_id",
        "year",
        "IF(n_debits = 0, NULL, debit) AS debit",
        "IF(n_credits = 0, NULL, credit) AS credit",
        f"CAST({sound} AS BIGINT) AS n_lines",
        "n_debits",
        "n_credits",
    ).where("n_lines <> 0")


def maintained_balances(kept: DataFrame, ledger: Ledger, chart: Chart = STANDARD) -> DataFrame:
    """The section balances, as ``build_section_balance`` gives them, from the kept totals.

    Accounts and sections are those of ``ledger``; its entries and lines are not read.
    """
    totals = kept.select("account_id", "year", "debit", "credit")
    shuffled = ledger.gather is not None
    return balances_of_totals(totals, ledger.account, ledger.section, chart, shuffled)
