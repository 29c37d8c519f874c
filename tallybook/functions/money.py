"""Exact sums, change ratios and printed amounts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Limbs of exact_sum: cents are split by powers of this, and four limbs hold 18 digits.
_BASE = 100_000
_LIMBS = 4


def exact_sum(amount: str) -> str:
    """The sum of a decimal(18,2), as decimal(38,2), in 64-bit sums.

    A plain sum keeps one big decimal that grows with every row. Here the cents of an amount,
    a 64-bit number, are split into limbs below 100,000, which add up as plain longs and are
    put together once per group. Exact for 9 * 10^13 rows per group, more than 100 TB can hold
    at two bytes a line, whatever their amounts; a sum beyond 38 digits raises. NULL amounts
    are skipped, and a group without any amount has a NULL sum. ANSI mode has to be on
    (``require_ansi``): without it, overflows would pass silently.
    """
    cents = f"CAST({amount} * 100 AS BIGINT)"
    parts = []
    for i in range(_LIMBS):
        limb = f"({cents} DIV {_BASE**i}L)" if i else cents
        if i < _LIMBS - 1:
            limb = f"{limb} % {_BASE}L"
        total = f"CAST(SUM({limb}) AS DECIMAL(19,0))"
        parts.append(f"CAST({total} * CAST({_BASE**i} AS DECIMAL(16,0)) AS DECIMAL(36,0))")
    return f"CAST(({' + '.join(parts)}) * 0.01BD AS DECIMAL(38,2))"


def _text(*expressions: object) -> None:
    for expression in expressions:
        if isinstance(expression, Column):
            raise TypeError("this form takes SQL text; for columns there is a *_column form")


def change_ratio(current: str, previous: str, missing: str = "0") -> str:
    """``(current - previous) / previous`` as a fraction, not a percentage.

    The difference is taken in exact decimals, the quotient in double. A missing side or a
    zero base gives ``missing``; pass "NULL" to tell those cases from "no change". A
    negative base flips the sign of the result, as the plain formula does.
    """
    _text(current, previous)
    change = f"CAST({current} - {previous} AS DOUBLE)"
    return f"coalesce(try_divide({change}, CAST({previous} AS DOUBLE)), {missing})"


def format_money(amount: str, digits: int = 2) -> str:
    """Text with thousands separators and fixed decimals; NULL stays NULL.

    ``format_number`` alone rounds half to even, so the half-up rounding comes first.
    """
    _text(amount)
    return f"format_number(round({amount}, {digits}), {digits})"


def indent(label: str) -> str:
    """Detail lines are printed two spaces in from totals and captions."""
    return f"concat('  ', {label})"


def change_ratio_column(
    current: Column | str, previous: Column | str, missing: float | None = 0.0
) -> Column:
    """``change_ratio`` of columns or of column names."""
    current, previous = (F.col(x) if isinstance(x, str) else x for x in (current, previous))
    ratio = F.try_divide((current - previous).cast("double"), previous.cast("double"))
    return ratio if missing is None else F.coalesce(ratio, F.lit(float(missing)))


def format_money_column(amount: Column | str, digits: int = 2) -> Column:
    """``format_money`` of a column or of a column name."""
    return F.format_number(F.round(amount, digits), digits)
