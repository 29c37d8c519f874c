"""Both statements with one column per year and the change from each year to the next.

The years are a list the caller gives. Each is compared with the one before it in the
list, also across a gap, and a year without data counts as missing.

Spine lines and balances meet in one aggregation by (company, line): the balances bring
the amounts, the spine marks which lines print. That is one shuffle, with the per-year
sums combined before it, where a pivot and a join to the spine would take three.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tallybook.chart import STANDARD, Chart, Statement, listed, order_in
from tallybook.functions import change_ratio, format_money, indent, quoted, row
from tallybook.operators.spine import spine_rows
from tallybook.operators.totals import has_period, inlined, statement_rows
from tallybook.plans.statements import display_balance
from tallybook.schema import LINE_ORDER, MONEY, RATIO

_LINE = ["company_id", "line_order", "line_label"]
_AMOUNT_LINE = f"struct<line_order:{LINE_ORDER},line_label:string,amount:{MONEY}>"


def _amount(condition: str, position: str, label: str, amount: str) -> str:
    line = row(
        line_order=f"CAST({position} AS {LINE_ORDER})",
        line_label=label,
        amount=f"CAST({amount} AS {MONEY})",
    )
    return f"IF({condition}, {line}, NULL)"


def _line_amounts(mart: DataFrame, statement: Statement, years: Sequence[int]) -> DataFrame:
    """Each section balance once per line it belongs to: its own and its totals."""
    own = _amount(
        order_in(statement.detail),
        "statement_section_order",
        indent("statement_section"),
        display_balance(statement),
    )
    totals = [
        _amount(order_in(t.orders), t.line_order, quoted(t.label), f"{t.sign} * balance")
        for t in statement.totals
    ]
    return (
        has_period(statement_rows(mart, statement))
        .where(f"year IN ({listed(years)})")
        .selectExpr("company_id", "year", inlined([own, *totals], _AMOUNT_LINE))
    )


def _year_over_year(
    mart: DataFrame,
    section: DataFrame,
    statement: Statement,
    company_id: int | None,
    years: Sequence[int],
) -> DataFrame:
    if not years:
        raise ValueError("years is empty")
    if len(set(years)) != len(years):
        raise ValueError(f"a year is listed twice in {years}")
    amounts = _line_amounts(mart, statement, years)
    if company_id is not None:
        amounts = amounts.where(f"company_id = {int(company_id)}")
    if not statement.is_balance_sheet:
        # P&L lines are matched by label, so a balance without one belongs to no line.
        amounts = amounts.where("line_label IS NOT NULL")
    spine = spine_rows(section, company_id, statement)
    balances = [
        F.expr(f"CAST(sum(amount) FILTER (WHERE year = {year}) AS {MONEY}) AS b{year}")
        for year in years
    ]
    return (
        amounts.selectExpr(*_LINE, "year", "amount", "false AS on_spine")
        .union(spine.selectExpr(*_LINE, "NULL AS year", "NULL AS amount", "true AS on_spine"))
        .groupBy(*_LINE)
        .agg(F.expr("bool_or(on_spine) AS on_spine"), *balances)
        .where("on_spine")
    )


def _printed(
    lines: DataFrame, years: Sequence[int], missing_ratio: str, money: str, ratio: str
) -> DataFrame:
    """``money`` and ``ratio`` are text templates for the two kinds of columns."""
    balances = [f"{money.format(f'coalesce(b{y}, 0)')} AS b{y}" for y in years]
    steps = list(zip(years, years[1:]))
    # Two digits of a year, unless that names two steps alike.
    short = [f"r{a % 100:02d}to{b % 100:02d}" for a, b in steps]
    names = short if len(set(short)) == len(short) else [f"r{a:04d}to{b:04d}" for a, b in steps]
    ratios = [
        f"{ratio.format(change_ratio(f'b{b}', f'b{a}', missing_ratio))} AS {name}"
        for (a, b), name in zip(steps, names)
    ]
    return lines.orderBy(*_LINE).selectExpr(*_LINE, *balances, *ratios)


def _numeric(lines: DataFrame, years: Sequence[int], missing_ratio: float | None) -> DataFrame:
    missing = "NULL" if missing_ratio is None else str(float(missing_ratio))
    money, ratio = f"CAST({{}} AS {MONEY})", f"CAST(round({{}}, 6) AS {RATIO})"
    return _printed(lines, years, missing, money, ratio)


def _text(lines: DataFrame, years: Sequence[int]) -> DataFrame:
    return _printed(lines, years, "0", format_money("{}"), format_money("{}"))


def pl_year_over_year(
    mart: DataFrame,
    section: DataFrame,
    company_id: int | None,
    years: Sequence[int],
    chart: Chart = STANDARD,
    missing_ratio: float | None = 0.0,
) -> DataFrame:
    """One row per P&L line: b{year} per year and r{yy}to{yy} per step.

    A missing balance prints as 0. A ratio with a missing side or a zero base is
    ``missing_ratio``; pass None to keep it apart from "no change". ``company_id=None``
    reports every company that has a section on the statement.
    """
    lines = _year_over_year(mart, section, chart.profit_loss, company_id, years)
    return _numeric(lines, years, missing_ratio)


def bs_year_over_year(
    mart: DataFrame,
    section: DataFrame,
    company_id: int | None,
    years: Sequence[int],
    chart: Chart = STANDARD,
    missing_ratio: float | None = 0.0,
) -> DataFrame:
    """As ``pl_year_over_year`` for the balance sheet; captions print zeros."""
    lines = _year_over_year(mart, section, chart.balance_sheet, company_id, years)
    return _numeric(lines, years, missing_ratio)


def pl_year_over_year_formatted(
    mart: DataFrame,
    section: DataFrame,
    company_id: int | None,
    years: Sequence[int],
    chart: Chart = STANDARD,
) -> DataFrame:
    """``pl_year_over_year`` as text, balances and ratios with two decimals."""
    return _text(_year_over_year(mart, section, chart.profit_loss, company_id, years), years)


def bs_year_over_year_formatted(
    mart: DataFrame,
    section: DataFrame,
    company_id: int | None,
    years: Sequence[int],
    chart: Chart = STANDARD,
) -> DataFrame:
    """``bs_year_over_year`` as text, balances and ratios with two decimals."""
    return _text(_year_over_year(mart, section, chart.balance_sheet, company_id, years), years)
