"""Sums over section balances: subtotals, the margin ratio and the identity check.

Each is one aggregation by (company, year) whose sums are conditional, so overlapping
sets of orders need no second read and no row is copied before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallybook.chart import STANDARD, Chart, Ratio, Statement, Total, order_in
from tallybook.functions import format_money, quoted, row
from tallybook.schema import LINE_ORDER, MONEY, RATIO


def statement_rows(mart: DataFrame, statement: Statement) -> DataFrame:
    return mart.where(f"is_balance_sheet_section = {int(statement.is_balance_sheet)}")


def has_period(df: DataFrame) -> DataFrame:
    """Rows that belong to a known company and year: no report can ask for the others."""
    return df.where("company_id IS NOT NULL AND year IS NOT NULL")


def line(position: str, label: str, balance: str, caption: bool = False) -> str:
    return row(
        line_order=f"CAST({position} AS {LINE_ORDER})",
        line_label=quoted(label),
        balance=f"CAST({balance} AS {MONEY})",
        is_caption=str(caption).lower(),
    )


def caption_lines(statement: Statement) -> list[str]:
    return [line(position, label, "NULL", True) for position, label in statement.captions]


#: What a line of a report holds.
LINE = f"struct<line_order:{LINE_ORDER},line_label:string,balance:{MONEY},is_caption:boolean>"


def inlined(lines: Sequence[str], kind: str = LINE) -> str:
    """One row per line that is not NULL; ``kind`` is the type of a line."""
    return f"inline(array_compact(CAST(array({', '.join(lines)}) AS array<{kind}>)))"


def _sum_of(condition: str) -> str:
    return f"sum(balance) FILTER (WHERE {condition})"


def _any(condition: str) -> str:
    return f"coalesce(bool_or({condition}), false)"


def total_sums(totals: Sequence[Total]) -> list[Column]:
    """For each total its signed sum, and whether any row qualifies for it."""
    sums = []
    for i, total in enumerate(totals):
        member = order_in(total.orders)
        sums.append(F.expr(f"{total.sign} * {_sum_of(member)} AS total_{i}"))
        sums.append(F.expr(f"{_any(member)} AS has_total_{i}"))
    return sums


def total_lines(totals: Sequence[Total]) -> list[str]:
    """The lines of ``total_sums``; NULL where no row qualified."""
    return [
        f"IF(has_total_{i}, {line(t.line_order, t.label, f'total_{i}')}, NULL)"
        for i, t in enumerate(totals)
    ]


def ratio_sums(ratio: Ratio) -> list[Column]:
    over, under = order_in((ratio.numerator,)), order_in((ratio.denominator,))
    return [
        F.expr(
            f"try_divide(-CAST({_sum_of(over)} AS DOUBLE), CAST({_sum_of(under)} AS DOUBLE)) "
            "AS ratio"
        ),
        F.expr(f"{_any(over)} AND {_any(under)} AS has_ratio"),
    ]


def _totals(mart: DataFrame, statement: Statement) -> DataFrame:
    lines = inlined(total_lines(statement.totals))
    return (
        statement_rows(mart, statement)
        .groupBy("company_id", "year")
        .agg(*total_sums(statement.totals), F.count(F.lit(1)))
        .selectExpr("company_id", "year", lines)
        .drop("is_caption")
    )


def pl_subtotals(mart: DataFrame, chart: Chart = STANDARD) -> DataFrame:
    """Gross profit, profit before taxes and net profit per (company, year).

    A subtotal exists only where at least one row qualifies for it. Net profit takes
    every order, also those that have no line of their own.
    """
    return _totals(mart, chart.profit_loss)


def bs_totals(mart: DataFrame, chart: Chart = STANDARD) -> DataFrame:
    """Total assets, total liabilities, and liabilities plus equity, signed for display."""
    return _totals(mart, chart.balance_sheet)


def gross_margin_ratio(mart: DataFrame, chart: Chart = STANDARD) -> DataFrame:
    """Cost of goods over revenue per (company, year), as a fraction.

    The name is the printed one. The value is a cost ratio, not (revenue - cost) / revenue.
    A company-year needs rows on both sides; zero revenue gives NULL.
    """
    ratio = chart.margin
    return (
        has_period(statement_rows(mart, chart.profit_loss))
        .where(order_in((ratio.numerator, ratio.denominator)))
        .groupBy("company_id", "year")
        .agg(*ratio_sums(ratio))
        .where("has_ratio")
        .selectExpr(
            "company_id", "year", f"CAST(round(ratio, 6) AS {RATIO}) AS gross_margin_ratio"
        )
    )


def _check(mart: DataFrame, chart: Chart, name: str, compared: str) -> DataFrame:
    """Both sides per company-year and the verdict on ``compared``, a text template."""
    assets, claims = order_in(chart.assets), order_in(chart.liabilities_and_equity)
    left = compared.format("total_assets")
    right = compared.format("total_liabilities_and_equity")
    return (
        has_period(statement_rows(mart, chart.balance_sheet))
        .groupBy("company_id", "year")
        .agg(
            F.expr(f"CAST({_sum_of(assets)} AS {MONEY}) AS total_assets"),
            F.expr(f"CAST(-{_sum_of(claims)} AS {MONEY}) AS total_liabilities_and_equity"),
            F.expr(f"{_any(assets)} AND {_any(claims)} AS has_both"),
        )
        .where("has_both")
        .selectExpr(
            "company_id",
            "year",
            "total_assets",
            "total_liabilities_and_equity",
            f"CASE WHEN {left} = {right} THEN 'A = L + E' "
            f"WHEN {left} != {right} THEN 'A != L + E' END AS {name}",
        )
    )


def balance_check(mart: DataFrame, chart: Chart = STANDARD) -> DataFrame:
    """Assets against liabilities plus equity, compared in whole units.

    All companies and years with rows on both sides.
    """
    return _check(mart, chart, "balance_check", "round({}, 0)")


def balance_check_prefix(mart: DataFrame, chart: Chart = STANDARD) -> DataFrame:
    """``balance_check`` as it comes out when the formatted texts are compared as numbers.

    A text such as 1,234,567.89 counts up to its first comma only, so the check passes as
    soon as the leading digit groups agree. Kept for users who must reproduce old verdicts.
    """
    leading = f"substring_index({format_money('{}')}, ',', 1)"
    return _check(
        mart, chart, "balance_check_prefix", f"bround(CAST({leading} AS {MONEY}), 0)"
    )
