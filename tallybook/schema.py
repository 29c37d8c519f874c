"""Table schemas and the one rule that brings a user's tables to them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# One journal line. Eighteen digits keep Spark on its 64-bit decimal.
AMOUNT = "decimal(18,2)"
# A line that is no decimal: digits enough for what a double tells apart.
FINE_AMOUNT = "decimal(30,10)"
# Sums of lines. A section that holds a third of 10^12 lines passes 10^16, which
# decimal(18,2) cannot store; decimal(28,2) is what sum(decimal(18,2)) returns.
MONEY = "decimal(28,2)"
# Wide enough for the largest MONEY divided by one cent.
RATIO = "decimal(38,6)"
# Line positions such as 3.65, and every section order that an int can hold.
LINE_ORDER = "decimal(12,2)"

ACCOUNT = {
    "account_id": "bigint",
    "profit_loss_section_id": "bigint",
    "balance_sheet_section_id": "bigint",
}

STATEMENT_SECTION = {
    "statement_section_id": "bigint",
    "is_balance_sheet_section": "tinyint",
    "company_id": "int",
    "statement_section_order": "int",
    "statement_section": "string",
}

JOURNAL_ENTRY = {
    "journal_entry_id": "bigint",
    "entry_date": "date",
    "cancelled": "tinyint",
}

JOURNAL_ENTRY_LINE_ITEM = {
    "journal_entry_id": "bigint",
    "account_id": "bigint",
    "debit": AMOUNT,
    "credit": AMOUNT,
}

SECTION_BALANCE = {
    "is_balance_sheet_section": "tinyint",
    "company_id": "int",
    "year": "int",
    "statement_section_order": "int",
    "statement_section": "string",
    "balance": MONEY,
}

# Number of rows of a company-year, and sums of their hashes by 16 bits each.
DIGEST = {
    "company_id": "int",
    "year": "int",
    "n_rows": "bigint",
    "hash_0": "bigint",
    "hash_1": "bigint",
    "hash_2": "bigint",
    "hash_3": "bigint",
}


def ddl(columns: dict[str, str]) -> str:
    return ", ".join(f"{name} {dtype}" for name, dtype in columns.items())


def casts(columns: dict[str, str]) -> list[str]:
    return [f"CAST({name} AS {dtype}) AS {name}" for name, dtype in columns.items()]


def amount_type(given: T.DataType) -> str:
    """The type in which amounts of the given type are summed; none loses a digit.

    Balances are rounded once, after the sum, so an amount finer than a cent is not rounded
    here.
    """
    if isinstance(given, T.DecimalType):
        fits = given.scale <= 2 and given.precision - given.scale <= 16
        return AMOUNT if fits else given.simpleString()
    if isinstance(given, (T.ByteType, T.ShortType, T.IntegerType, T.NullType)):
        return AMOUNT
    return "decimal(20,0)" if isinstance(given, T.LongType) else FINE_AMOUNT


def with_amounts(df: DataFrame, columns: dict[str, str]) -> dict[str, str]:
    """``columns`` with the amounts in the types that ``df`` needs."""
    return {
        name: amount_type(df.schema[name].dataType) if dtype == AMOUNT else dtype
        for name, dtype in columns.items()
    }


def with_stored_flag(df: DataFrame, columns: dict[str, str]) -> dict[str, str]:
    """``columns`` with ``cancelled`` in the stored whole-number type: no cast is in the way of
    a filter on it."""
    whole = {"tinyint", "smallint", "int", "bigint"}
    given = dict(df.dtypes).get("cancelled")
    return columns | {"cancelled": given} if given in whole else columns


def conform(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Select and cast exactly these columns; others are never read."""
    missing = [name for name in columns if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; the table has {df.columns}")
    return df.selectExpr(*casts(with_amounts(df, columns)))
