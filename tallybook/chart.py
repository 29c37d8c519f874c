"""The chart of lines: which section orders make up which printed line.

Everything the reports know about line positions, signs and captions is stated here,
so that another chart of lines needs another ``Chart`` and no other change.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass


@dataclass(frozen=True)
class Total:
    """A calculated line: ``sign * sum(balance)`` over ``orders`` (None = every order)."""

    line_order: str
    label: str
    orders: tuple[int, ...] | None
    sign: int = 1


@dataclass(frozen=True)
class Ratio:
    """A calculated line: ``-sum(numerator) / sum(denominator)``."""

    line_order: str
    label: str
    numerator: int
    denominator: int


@dataclass(frozen=True)
class Statement:
    """One report: detail lines with their display sign, totals and caption rows."""

    is_balance_sheet: bool
    plain: tuple[int, ...]
    negated: tuple[int, ...]
    totals: tuple[Total, ...]
    captions: tuple[tuple[str, str], ...] = ()

    @property
    def detail(self) -> tuple[int, ...]:
        return self.plain + self.negated


@dataclass(frozen=True)
class Chart:
    income: tuple[int, ...]
    expense: tuple[int, ...]
    assets: tuple[int, ...]
    liabilities_and_equity: tuple[int, ...]
    profit_loss: Statement
    balance_sheet: Statement
    margin: Ratio


# The orders, positions and captions a ledger user already prints.
STANDARD = Chart(
    income=(1, 4, 5, 11),
    expense=(2, 3, 6, 7, 8, 9, 10, 12, 13),
    assets=(1, 2, 3),
    liabilities_and_equity=(4, 5, 6, 7),
    profit_loss=Statement(
        is_balance_sheet=False,
        plain=tuple(range(1, 14)),
        negated=(),
        totals=(
            Total("9.5", "GROSS PROFIT", tuple(range(1, 10))),
            Total("11.5", "PROFIT BEFORE TAXES", tuple(range(1, 12))),
            Total("13.5", "NET PROFIT", None),
        ),
    ),
    balance_sheet=Statement(
        is_balance_sheet=True,
        plain=(1, 2, 3),
        negated=(4, 5, 6, 7),
        totals=(
            Total("3.6", "TOTAL ASSETS", (1, 2, 3)),
            Total("6.5", "TOTAL LIABILITIES", (4, 5, 6), sign=-1),
            Total("7.5", "TOTAL LIABILITIES AND SHAREHOLDERS EQUITY", (4, 5, 6, 7), sign=-1),
        ),
        captions=(
            ("0.1", "ASSETS"),
            ("3.65", ""),
            ("3.7", "LIABILITIES AND SHAREHOLDERS EQUITY"),
            ("6.6", "SHAREHOLDERS EQUITY"),
        ),
    ),
    margin=Ratio("400", "Gross Margin Ratio %", numerator=7, denominator=1),
)


def listed(values: Iterable[int]) -> str:
    """The numbers as the inside of an SQL IN list."""
    return ", ".join(str(int(v)) for v in values)


def order_in(orders: Sequence[int] | None) -> str:
    """The SQL condition that a section order is one of ``orders`` (None = any)."""
    if orders is None:
        return "true"
    return f"statement_section_order IN ({listed(orders)})" if orders else "false"
