"""Every report from one pass over the section balances.

A balance is turned into one cell for each line it belongs to, on any report. Cells are summed per
line and year, combined before the shuffle, and the years of a line come together in one row,
with the spine. That row holds what both statements, the check and both comparisons print of the
line, so the balances are read once, whatever the number of reports.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tallybook.chart import STANDARD, Chart, Statement, listed, order_in
from tallybook.functions import change_ratio, indent, quoted, row
from tallybook.operators.spine import spine_rows
from tallybook.operators.totals import has_period
from tallybook.plans.statements import display_balance
from tallybook.schema import LINE_ORDER, MONEY, RATIO

#: What a row of the result belongs to.
REPORTS = (
    "pl_statement",
    "balance_sheet",
    "balance_check",
    "pl_year_over_year",
    "bs_year_over_year",
)

_LINE = ["company_id", "is_bs", "part", "line_order", "line_label"]
_CELL = f"struct<part:string,line_order:{LINE_ORDER},line_label:string,kind:string,amount:{MONEY}>"
_PRINTED = (
    f"array<struct<report:string,year:int,line_order:{LINE_ORDER},line_label:string,"
    f"balance:{MONEY},change:{RATIO}>>"
)


def _cell(condition: str, part: str, position: str, label: str, kind: str, amount: str) -> str:
    cell = row(
        part=quoted(part),
        line_order=f"CAST({position} AS {LINE_ORDER})",
        line_label=label,
        kind=quoted(kind),
        amount=f"CAST({amount} AS {MONEY})",
    )
    return f"IF({condition}, {cell}, NULL)"


def _cells(statement: Statement, chart: Chart) -> list[str]:
    """The cells of a balance of this statement; NULL for lines it does not belong to."""
    on = f"is_bs = {str(statement.is_balance_sheet).lower()}"
    cells = [
        _cell(
            f"{on} AND {order_in(statement.detail)}",
            "line",
            "statement_section_order",
            indent("statement_section"),
            "own",
            display_balance(statement),
        )
    ]
    for t in statement.totals:
        member = f"{on} AND {order_in(t.orders)}"
        amount = f"{t.sign} * balance"
        cells.append(_cell(member, "line", t.line_order, quoted(t.label), "total", amount))
    for position, label in statement.captions:
        cells.append(_cell(on, "line", position, quoted(label), "caption", "NULL"))
    if statement.is_balance_sheet:
        sides = ("check", "NULL", "NULL", chart.assets, chart.liabilities_and_equity)
    else:
        ratio = chart.margin
        over, under = (ratio.numerator,), (ratio.denominator,)
        sides = ("ratio", ratio.line_order, quoted(ratio.label), over, under)
    part, position, label, first, second = sides
    for kind, orders in (("first", first), ("second", second)):
        cells.append(_cell(f"{on} AND {order_in(orders)}", part, position, label, kind, "balance"))
    return cells


def _printed(report: str, year: str, balance: str, label: str = "line_label", change: str = "NULL") -> str:
    fields = row(
        report=report,
        year=year,
        line_order="line_order",
        line_label=label,
        balance=f"CAST({balance} AS {MONEY})",
        change=f"CAST({change} AS {RATIO})",
    )
    return fields


def _of_year(rows: str, condition: str, printed: str) -> str:
    return f"transform(filter({rows}, c -> {condition}), c -> {printed})"


def all_reports(
    mart: DataFrame,
    section: DataFrame,
    years: Sequence[int],
    company_id: int | None = None,
    chart: Chart = STANDARD,
) -> DataFrame:
    """report, company_id, year, line_order, line_label, balance, change, in no order.

    Rows are tagged by ``REPORTS``. Both statements and the check have the given years; both
    comparisons have a row for each of these years and each line of the spine, a missing balance
    being 0, with the change from the year before in the list, rounded to six digits, which is
    NULL for the first. The check has its verdict as label and assets less liabilities and equity
    as balance. Everything else is as in the reports by themselves.
    """
    if not years:
        raise ValueError("years is empty")
    if len(set(years)) != len(years):
        raise ValueError(f"a year is listed twice in {years}")
    rows = has_period(mart).where(f"is_balance_sheet_section IN (0, 1) AND year IN ({listed(years)})")
    if company_id is not None:
        rows = rows.where(f"company_id = {int(company_id)}")
    cells = _cells(chart.profit_loss, chart) + _cells(chart.balance_sheet, chart)
    amounts = rows.withColumn("is_bs", F.expr("is_balance_sheet_section = 1")).selectExpr(
        "company_id",
        "is_bs",
        f"inline(array_compact(CAST(array({', '.join(cells)}) AS array<{_CELL}>)))",
        "year",
    )
    columns = [*_LINE, "kind", "amount", "year"]
    for statement in (chart.profit_loss, chart.balance_sheet):
        spine = spine_rows(section, company_id, statement).selectExpr(
            "company_id",
            f"{str(statement.is_balance_sheet).lower()} AS is_bs",
            "'line' AS part",
            "line_order",
            "line_label",
            "'spine' AS kind",
            f"CAST(NULL AS {MONEY}) AS amount",
            "CAST(NULL AS INT) AS year",
        )
        amounts = amounts.select(columns).union(spine)
    by_year = amounts.groupBy(*_LINE, "year").agg(
        # A section has one balance for each kind of link: two at most.
        F.expr("collect_list(struct(amount)) FILTER (WHERE kind = 'own') AS own"),
        F.expr("sum(amount) FILTER (WHERE kind IN ('own', 'total')) AS amount"),
        *[
            F.expr(f"{what} FILTER (WHERE kind = '{kind}') AS {prefix}{kind}")
            for kind in ("total", "first", "second")
            for prefix, what in (("", "sum(amount)"), ("n_", "count(1)"))
        ],
        F.expr("bool_or(kind = 'caption') AS is_caption"),
    )
    state = [name for name in by_year.columns if name not in _LINE]
    # At most one row per year, and one of the spine.
    lines = by_year.groupBy(*_LINE).agg(
        F.collect_list(F.struct(*state)).alias("cells"),
        F.expr("bool_or(year IS NULL) AS on_spine"),
    )
    # P&L lines are matched by label, so a balance without one belongs to no line.
    matched = "c.year IS NOT NULL AND (is_bs OR line_label IS NOT NULL)"
    by_key = f"map_from_entries(transform(filter(cells, c -> {matched}), c -> struct(c.year, c.amount)))"
    statement = "IF(is_bs, 'balance_sheet', 'pl_statement')"
    own = f"transform(c.own, o -> {_printed(statement, 'c.year', 'o.amount')})"
    compared = []
    for before, year in zip([None, *years], years):
        now = f"try_element_at(amounts, {int(year)})"
        change = "NULL"
        if before is not None:
            change = f"round({change_ratio(now, f'try_element_at(amounts, {int(before)})')}, 6)"
        report = "IF(is_bs, 'bs_year_over_year', 'pl_year_over_year')"
        compared.append(_printed(report, str(int(year)), f"coalesce({now}, 0)", change=change))
    ratio = "round(try_divide(-CAST(c.first AS DOUBLE), CAST(c.second AS DOUBLE)), 2)"
    first, second = f"CAST(c.first AS {MONEY})", f"CAST(-c.second AS {MONEY})"
    verdict = (
        f"CASE WHEN round({first}, 0) = round({second}, 0) THEN 'A = L + E' "
        f"WHEN round({first}, 0) != round({second}, 0) THEN 'A != L + E' END"
    )
    both = "c.n_first > 0 AND c.n_second > 0"
    parts = [
        f"flatten(transform(cells, c -> {own}))",
        _of_year("cells", "c.n_total > 0", _printed(statement, "c.year", "c.total")),
        _of_year("cells", "c.is_caption", _printed(statement, "c.year", "NULL")),
        _of_year("cells", f"part = 'ratio' AND {both}", _printed(statement, "c.year", ratio)),
        _of_year(
            "cells",
            f"part = 'check' AND {both}",
            _printed("'balance_check'", "c.year", f"{first} - {second}", verdict),
        ),
        f"IF(on_spine, array({', '.join(compared)}), array())",
    ]
    printed = ", ".join(f"CAST({part} AS {_PRINTED})" for part in parts)
    return (
        lines.withColumn("amounts", F.expr(by_key))
        .selectExpr("company_id", f"inline(concat({printed}))")
        .select("report", "company_id", "year", "line_order", "line_label", "balance", "change")
    )
