"""The lines a statement prints whether or not they had any activity."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallybook.chart import STANDARD, Chart, Statement
from tallybook.functions import indent, quoted, row
from tallybook.schema import LINE_ORDER


_LINES = f"array<struct<line_order:{LINE_ORDER},line_label:string>>"


def _line(position: str, label: str) -> str:
    return row(line_order=f"CAST({position} AS {LINE_ORDER})", line_label=label)


def spine_rows(section: DataFrame, company_id: int | None, statement: Statement) -> DataFrame:
    """``statement_spine`` before duplicates are removed."""
    calculated = [(t.line_order, t.label) for t in statement.totals] + list(statement.captions)
    fixed = [_line(position, quoted(label)) for position, label in calculated]
    own = _line("statement_section_order", indent("statement_section"))

    flag = "!= 0" if statement.is_balance_sheet else "= 0"
    sections = section.where(f"is_balance_sheet_section {flag}")
    if company_id is None:
        sections = sections.where("company_id IS NOT NULL")
        return sections.selectExpr("company_id", f"inline(array({', '.join([own, *fixed])}))")
    rows = sections.where(f"company_id = {int(company_id)}").selectExpr(
        "company_id", f"inline(array({own}))"
    )
    always = section.sparkSession.sql(
        f"SELECT {int(company_id)} AS company_id, inline(CAST(array({', '.join(fixed)}) AS {_LINES}))"
    )
    return rows.union(always)


def statement_spine(
    section: DataFrame,
    company_id: int | None,
    statement: Statement = STANDARD.profit_loss,
) -> DataFrame:
    """Every section of a company on this statement plus the calculated lines.

    With ``company_id=None``: the same for each company that has a section on it. The
    balance sheet takes any non-zero section flag.
    """
    return spine_rows(section, company_id, statement).distinct()


def pl_spine(
    section: DataFrame, company_id: int | None = None, chart: Chart = STANDARD
) -> DataFrame:
    return statement_spine(section, company_id, chart.profit_loss)


def bs_spine(
    section: DataFrame, company_id: int | None = None, chart: Chart = STANDARD
) -> DataFrame:
    return statement_spine(section, company_id, chart.balance_sheet)
