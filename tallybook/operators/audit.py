"""From a failed check assets = liabilities + equity to the entries behind it.

The lines of every entry are summed per company before they meet their entry, so an entry with
very many lines is combined where it is read, and entries that balance go before the join. The
largest of a company-year are found by a tournament: each of its entries plays in one of some
buckets, whose winner is a plain maximum, combined before the shuffle. The k-th best winner is
no better than the k-th best entry, so no entry below it can be among the first k. What is left
are a few entries per company-year, and only these are ranked. Entries are dealt by company, year
and bucket, so that a company-year with a share of all entries is not one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tallybook.chart import STANDARD, Chart, order_in
from tallybook.functions import row
from tallybook.operators.balances import PL_LINK, live_entries, live_lines, require_ansi, signed_debit
from tallybook.schema import AMOUNT, MONEY, casts, with_amounts
from tallybook.sources.ledger import Ledger

#: Buckets of the tournament for each entry that is asked for. With 16 of them few entries besides
#: the first k come through, however many there are; those equal to the k-th do.
BUCKETS_OF_A_PLACE = 16

_PERIOD = ["company_id", "year"]


def _weights(ledger: Ledger, company_id: int | None, chart: Chart) -> DataFrame:
    """What a debit and a credit on an account add to the difference of a company."""
    counted = order_in(chart.assets + chart.liabilities_and_equity)
    section = ledger.section.where(
        f"is_balance_sheet_section = 1 AND company_id IS NOT NULL AND {counted}"
    )
    if company_id is not None:
        section = section.where(f"company_id = {int(company_id)}")
    pl = row(is_pl="true", statement_section_id=PL_LINK)
    bs = row(is_pl="false", statement_section_id="balance_sheet_section_id")
    by_debit = f"IF(is_pl, {signed_debit(chart, '1')}, 1)"
    return (
        ledger.account.selectExpr("account_id", f"inline(array({pl}, {bs}))")
        .join(section, "statement_section_id")
        .groupBy("account_id", "company_id")
        .agg(
            F.expr(f"CAST(coalesce(sum({by_debit}), 0) AS INT) AS of_debit"),
            F.expr("CAST(-sum(IF(is_pl, 0, 1)) AS INT) AS of_credit"),
        )
    )


def entry_differences(
    ledger: Ledger,
    years: Sequence[int] | None = None,
    company_id: int | None = None,
    chart: Chart = STANDARD,
) -> DataFrame:
    """company_id, year, journal_entry_id, difference of live entries that do not balance.

    The difference is what an entry adds to assets less liabilities and equity, by the sections
    that ``balance_check`` compares. Those of a company-year add up to the difference that the
    check finds. The one exception is a section that an account reaches as both kinds of link
    with equal balances: the mart holds these once, here both count.
    """
    require_ansi(ledger.line.sparkSession)
    if ledger.headers_on_lines:
        keys, lines = ["journal_entry_id", "year"], live_lines(ledger, years, company_id)
    else:
        keys, lines = list(ledger.entry_keys), ledger.lines_of(company_id)
    postings = ledger.postings(lines)
    types = with_amounts(postings, {"debit": AMOUNT, "credit": AMOUNT})
    weighed = postings.selectExpr(*keys, "account_id", *casts(types)).join(
        _weights(ledger, company_id, chart), "account_id"
    )
    added = F.expr("sum(of_debit * coalesce(debit, 0) + of_credit * coalesce(credit, 0)) AS added")
    by_entry = weighed.groupBy(*keys, "company_id").agg(added).where("added <> 0")
    if not ledger.headers_on_lines:
        by_entry = by_entry.join(live_entries(ledger, years), keys)
    # An entry may have several parts, and its header several rows: they are one entry.
    return (
        by_entry.where("year IS NOT NULL")
        .groupBy("company_id", "year", "journal_entry_id")
        .agg(F.expr(f"CAST(sum(added) AS {MONEY}) AS difference"))
        .where("difference <> 0")
    )


def largest_differences(
    ledger: Ledger,
    k: int,
    years: Sequence[int] | None = None,
    company_id: int | None = None,
    chart: Chart = STANDARD,
) -> DataFrame:
    """The ``k`` entries of every company-year that move assets and claims apart the most.

    Returns company_id, year, place from 1, journal_entry_id, difference; and for the whole
    company-year its total_difference and n_entries, the number of entries that do not balance.
    The larger amount comes first, whatever its sign, and of equal ones the smaller id. A
    company-year in which every entry balances has no row.
    """
    if k < 1:
        raise ValueError(f"k is {k}")
    buckets = BUCKETS_OF_A_PLACE * k
    entries = entry_differences(ledger, years, company_id, chart).withColumns(
        {
            "size": F.expr("abs(difference)"),
            # Never NULL, so that the join below sends no filter down to one of its sides only:
            # both stay alike, and the lines are read once.
            "bucket": F.expr(f"coalesce(CAST(pmod(xxhash64(journal_entry_id), {buckets}) AS INT), 0)"),
        }
    )
    bars = (
        entries.groupBy(*_PERIOD, "bucket")
        .agg(
            F.max("size").alias("best"), F.sum("difference").alias("total"), F.count("*").alias("n")
        )
        # At most one row per bucket comes together here.
        .groupBy(*_PERIOD)
        .agg(
            # With fewer winners than places there is no bar, and all entries pass.
            F.expr(f"get(sort_array(collect_list(best), false), {k - 1}) AS bar"),
            F.expr(f"CAST(sum(total) AS {MONEY}) AS total_difference"),
            F.expr("sum(n) AS n_entries"),
            F.collect_list("bucket").alias("dealt"),
        )
        .withColumn("bucket", F.explode("dealt"))
        .drop("dealt")
    )
    first = Window.partitionBy(*_PERIOD).orderBy(F.desc("size"), "journal_entry_id")
    return (
        entries.join(bars, [*_PERIOD, "bucket"])
        .where("bar IS NULL OR size >= bar")
        .withColumn("place", F.row_number().over(first))
        .where(F.col("place") <= k)
        .select(
            *_PERIOD, "place", "journal_entry_id", "difference", "total_difference", "n_entries"
        )
    )
