"""The profit-and-loss statement and the balance sheet.

Detail lines are a projection of the section balances: a section that comes with two
balances prints twice. Totals, the ratio and the captions come from one aggregation by
(company, year). Amounts stay numeric; the ``*_formatted`` forms turn them into text last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallybook.chart import STANDARD, Chart, Statement, order_in
from tallybook.functions import format_money, indent
from tallybook.operators.totals import (
    caption_lines,
    has_period,
    inlined,
    line,
    ratio_sums,
    statement_rows,
    total_lines,
    total_sums,
)
from tallybook.schema import LINE_ORDER

_KEYS = ["company_id", "year"]
_SORT = ["company_id", "year", "line_order", "line_label", "balance"]
_COLUMNS = ["company_id", "year", "line_order", "line_label"]


def _selected(
    mart: DataFrame, statement: Statement, company_id: int | None, year: int | None
) -> DataFrame:
    rows = has_period(statement_rows(mart, statement))
    if company_id is not None:
        rows = rows.where(f"company_id = {int(company_id)}")
    if year is not None:
        rows = rows.where(f"year = {int(year)}")
    return rows


def display_balance(statement: Statement) -> str:
    return f"IF({order_in(statement.negated)}, -balance, balance)"


def _detail(rows: DataFrame, statement: Statement) -> DataFrame:
    return rows.where(order_in(statement.detail)).selectExpr(
        *_KEYS,
        f"CAST(statement_section_order AS {LINE_ORDER}) AS line_order",
        f"{indent('statement_section')} AS line_label",
        f"{display_balance(statement)} AS balance",
        "false AS is_caption",
    )


def _pl_lines(
    mart: DataFrame, company_id: int | None, year: int | None, chart: Chart
) -> DataFrame:
    statement, ratio = chart.profit_loss, chart.margin
    rows = _selected(mart, statement, company_id, year)
    ratio_line = line(ratio.line_order, ratio.label, "round(ratio, 2)")
    lines = [*total_lines(statement.totals), f"IF(has_ratio, {ratio_line}, NULL)"]
    calculated = (
        rows.groupBy(*_KEYS)
        .agg(*total_sums(statement.totals), *ratio_sums(ratio))
        .selectExpr(*_KEYS, inlined(lines))
    )
    return _detail(rows, statement).union(calculated)


def _bs_lines(
    mart: DataFrame, company_id: int | None, year: int | None, chart: Chart
) -> DataFrame:
    statement = chart.balance_sheet
    rows = _selected(mart, statement, company_id, year)
    totals, captions = total_lines(statement.totals), caption_lines(statement)
    grouped = rows.groupBy(*_KEYS).agg(*total_sums(statement.totals), F.count(F.lit(1)))
    if company_id is None or year is None:
        calculated = grouped.selectExpr(*_KEYS, inlined(totals + captions))
    else:
        # One sheet was asked for: its captions print even without any balance.
        calculated = grouped.selectExpr(*_KEYS, inlined(totals)).union(
            mart.sparkSession.sql(
                f"SELECT {int(company_id)} AS company_id, {int(year)} AS year, {inlined(captions)}"
            )
        )
    return _detail(rows, statement).union(calculated)


def _numeric(lines: DataFrame) -> DataFrame:
    return lines.orderBy(*_SORT).select(*_COLUMNS, "balance")


def _text(lines: DataFrame) -> DataFrame:
    text = f"IF(is_caption, '', {format_money('balance')}) AS balance"
    return lines.orderBy(*_SORT).selectExpr(*_COLUMNS, text)


def pl_statement(
    mart: DataFrame,
    company_id: int | None = None,
    year: int | None = None,
    chart: Chart = STANDARD,
) -> DataFrame:
    """company_id, year, line_order, line_label, balance in printing order.

    None for a parameter means all companies or all years. The ratio line holds a
    fraction rounded to two digits; ``gross_margin_ratio`` has it in full.
    """
    return _numeric(_pl_lines(mart, company_id, year, chart))


def balance_sheet(
    mart: DataFrame,
    company_id: int | None = None,
    year: int | None = None,
    chart: Chart = STANDARD,
) -> DataFrame:
    """As ``pl_statement``; captions have a NULL balance.

    Liabilities and equity are shown with the opposite sign. The sheet of one given
    company and year always has its captions; otherwise each company-year found has.
    """
    return _numeric(_bs_lines(mart, company_id, year, chart))


def pl_statement_formatted(
    mart: DataFrame,
    company_id: int | None = None,
    year: int | None = None,
    chart: Chart = STANDARD,
) -> DataFrame:
    """``pl_statement`` with balances as text."""
    return _text(_pl_lines(mart, company_id, year, chart))


def balance_sheet_formatted(
    mart: DataFrame,
    company_id: int | None = None,
    year: int | None = None,
    chart: Chart = STANDARD,
) -> DataFrame:
    """``balance_sheet`` with balances as text; captions have an empty one."""
    return _text(_bs_lines(mart, company_id, year, chart))
