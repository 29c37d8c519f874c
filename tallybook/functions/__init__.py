"""Expressions shared by the operators.

Each function takes and returns SQL expression text, for ``selectExpr`` or ``F.expr``; the
``*_column`` forms take and return columns.
"""

from tallybook.functions.money import (
    change_ratio,
    change_ratio_column,
    exact_sum,
    format_money,
    format_money_column,
    indent,
)
from tallybook.functions.text import quoted, row

__all__ = [
    "change_ratio",
    "change_ratio_column",
    "exact_sum",
    "format_money",
    "format_money_column",
    "indent",
    "quoted",
    "row",
]
