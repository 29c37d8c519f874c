"""Section balances: journal lines classified, signed and summed.

The journal is read once and summed per (account, year) before it meets the chart of
accounts. The sums of that step are exact decimals, so summing them again per section
gives the same balance as summing the lines, and the step shrinks the journal to
accounts x years rows: all later joins and shuffles work on that.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallybook.chart import STANDARD, Chart, listed, order_in
from tallybook.functions import exact_sum, row
from tallybook.schema import AMOUNT, MONEY, SECTION_BALANCE, casts, with_amounts
from tallybook.sources.ledger import Ledger

_KEYS = [name for name in SECTION_BALANCE if name != "balance"]
_NET = "coalesce(debit, 0) - coalesce(credit, 0)"
PL_LINK = "nullif(profit_loss_section_id, 0)"


def _live(years: Sequence[int] | None) -> str:
    """The condition on a header that its entry counts."""
    live = "cancelled = 0"
    if years is not None:
        if not years:
            raise ValueError("years is empty; None means all years")
        # The date range reaches the file scan, which year(entry_date) would not.
        live += (
            f" AND entry_date BETWEEN DATE'{min(years):04d}-01-01' AND DATE'{max(years):04d}-12-31'"
            f" AND year(entry_date) IN ({listed(years)})"
        )
    return live


def live_entries(ledger: Ledger, years: Sequence[int] | None = None) -> DataFrame:
    """Keys and year of the entries that are not cancelled."""
    return ledger.entry.where(_live(years)).selectExpr(
        *ledger.entry_keys, "year(entry_date) AS year"
    )


def live_lines(ledger: Ledger, years: Sequence[int] | None, company_id: int | None) -> DataFrame:
    """Lines that have their header with them, with their year, of entries that count."""
    lines = ledger.lines_of(company_id).where(_live(years))
    return lines.withColumn("year", F.expr("year(entry_date)")).drop("entry_date", "cancelled")


def joined_lines(
    ledger: Ledger, years: Sequence[int] | None = None, company_id: int | None = None
) -> DataFrame:
    """Lines of live entries with their year, not yet expanded.

    Lines of one company have few accounts, so they stay where they are.
    """
    if ledger.headers_on_lines:
        lines = live_lines(ledger, years, company_id)
    else:
        entry = live_entries(ledger, years)
        if company_id is None:
            entry = ledger.hashed(entry)
        lines = ledger.lines_of(company_id).join(entry, list(ledger.entry_keys))
    return lines if company_id is not None else ledger.gathered(lines)


def posted_lines(
    ledger: Ledger, years: Sequence[int] | None = None, company_id: int | None = None
) -> DataFrame:
    """Lines of live entries: account_id, year, debit, credit.

    With ``company_id``, lines of other companies are left out before the join where the
    ledger can tell them apart; some may still come.

    Neither side of this join has a size bound, so it carries no broadcast hint: Spark
    broadcasts entries only below its threshold and otherwise sort-merges, or hashes the entries
    of a partition where the ledger gathers lines. In both, adaptive execution splits an entry
    that holds a large share of the lines.
    """
    postings = ledger.postings(joined_lines(ledger, years, company_id))
    amounts = with_amounts(postings, {"debit": AMOUNT, "credit": AMOUNT})
    return postings.selectExpr("account_id", "year", *casts(amounts))


def require_ansi(spark: SparkSession) -> None:
    if spark.conf.get("spark.sql.ansi.enabled") != "true":
        raise ValueError("sums need spark.sql.ansi.enabled: without it, overflows pass silently")


def account_totals(posted: DataFrame) -> DataFrame:
    """Debit and credit per (account, year); a side without any amount is NULL.

    Amounts that are no decimal(18,2) are summed as they are, at their own scale.
    """
    require_ansi(posted.sparkSession)
    types = dict(posted.dtypes)
    sums = [
        F.expr(exact_sum(side) if types[side] == AMOUNT else f"sum({side})").alias(side)
        for side in ("debit", "credit")
    ]
    return posted.groupBy("account_id", "year").agg(*sums)


def signed_debit(chart: Chart, debit: str = "coalesce(debit, 0)") -> str:
    """Income is positive and expense negative; an order that is neither has no balance."""
    return (
        f"CASE WHEN {order_in(chart.income)} THEN {debit} "
        f"WHEN {order_in(chart.expense)} THEN -{debit} END"
    )


def with_sections(
    totals: DataFrame, links: DataFrame, section: DataFrame, shuffled: bool = False
) -> DataFrame:
    """Sums of accounts with the sections of ``links``, which has an account and a section a row.

    Spark takes accounts for as small as the files they are derived from, and would broadcast
    them however many a row of those yields. With ``shuffled``, it broadcasts neither accounts
    nor sections: they meet first, so that no join of the sums brings those of many accounts to
    one section, and sums meet them in sort-merge joins, whose tasks hold a partition and spill.
    """
    if not shuffled:
        return totals.join(links, "account_id").join(section, "statement_section_id")
    linked = links.join(section.hint("merge"), "statement_section_id")
    return totals.join(linked.hint("merge"), "account_id")


def _balances(summed: DataFrame, balance: str) -> DataFrame:
    return summed.selectExpr(*_KEYS, f"CAST({balance} AS {MONEY}) AS balance")


def pl_section_balance(
    ledger: Ledger, chart: Chart = STANDARD, years: Sequence[int] | None = None
) -> DataFrame:
    """Profit-and-loss balances per (flag, company, year, order, section).

    Only debits count, for income and expense alike. The flag is the section's own: an
    account whose P&L link points to a balance-sheet section is carried with flag 1.
    """
    links = ledger.account.selectExpr("account_id", f"{PL_LINK} AS statement_section_id")
    totals = account_totals(posted_lines(ledger, years))
    summed = (
        with_sections(totals, links, ledger.section, ledger.gather is not None)
        .groupBy(*_KEYS)
        .agg(F.expr("sum(debit) AS debit"))
    )
    return _balances(summed, signed_debit(chart))


def bs_section_balance(ledger: Ledger, years: Sequence[int] | None = None) -> DataFrame:
    """Balance-sheet balances, debit minus credit, of sections with a non-zero order."""
    links = ledger.account.selectExpr(
        "account_id", "balance_sheet_section_id AS statement_section_id"
    )
    section = ledger.section.where("statement_section_order != 0")
    totals = account_totals(posted_lines(ledger, years))
    summed = (
        with_sections(totals, links, section, ledger.gather is not None)
        .groupBy(*_KEYS)
        .agg(F.expr(f"sum({_NET}) AS net"))
    )
    return _balances(summed, "net")


def build_section_balance(
    ledger: Ledger,
    chart: Chart = STANDARD,
    years: Sequence[int] | None = None,
    company_id: int | None = None,
) -> DataFrame:
    """The union, without duplicates, of both kinds of section balance.

    With ``company_id``, only the balances of that company, and only its lines are joined.

    One pass: an account offers each of its links as a row, and one aggregation sums both
    kinds side by side. A section reached through both links yields two rows that differ
    in ``balance`` only, or one row if the balances are equal.
    """
    section = ledger.section
    if company_id is not None:
        section = section.where(f"company_id = {int(company_id)}")
    totals = account_totals(posted_lines(ledger, years, company_id))
    shuffled = company_id is None and ledger.gather is not None
    return balances_of_totals(totals, ledger.account, section, chart, shuffled)


def balances_of_totals(
    totals: DataFrame,
    account: DataFrame,
    section: DataFrame,
    chart: Chart = STANDARD,
    shuffled: bool = False,
) -> DataFrame:
    """Section balances from the debit and credit of every account and year.

    ``shuffled`` is that of ``with_sections``.
    """
    pl = row(is_pl="true", statement_section_id=PL_LINK)
    bs = row(is_pl="false", statement_section_id="balance_sheet_section_id")
    links = account.selectExpr("account_id", f"inline(array({pl}, {bs}))")
    summed = (
        with_sections(totals, links, section, shuffled)
        .where("is_pl OR statement_section_order != 0")
        .groupBy(*_KEYS)
        .agg(
            F.expr("sum(debit) FILTER (WHERE is_pl) AS debit"),
            F.expr(f"sum({_NET}) FILTER (WHERE NOT is_pl) AS net"),
            F.expr("bool_or(is_pl) AS has_pl"),
            F.expr("bool_and(is_pl) AS only_pl"),
        )
    )
    pl_balance, bs_balance = (f"CAST({b} AS {MONEY})" for b in (signed_debit(chart), "net"))
    return summed.selectExpr(
        *_KEYS,
        f"explode(CASE WHEN only_pl THEN array({pl_balance}) "
        f"WHEN NOT has_pl THEN array({bs_balance}) "
        f"ELSE array_distinct(array({pl_balance}, {bs_balance})) END) AS balance",
    )
