"""A ledger derived from an ``orders`` / ``lineitem`` star schema.

Every order is a journal entry and every order line posts up to three amounts: one to a
profit-and-loss account, one to an asset and one, as a credit, to a liability or equity
account. Every two suppliers are a company, so companies, sections and accounts grow with the
data. FIXTURES.md section 2 has the mapping.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallybook.functions import quoted, row
from tallybook.schema import AMOUNT, STATEMENT_SECTION, casts
from tallybook.sources.ledger import Ledger

# Suppliers of one company.
SUPPLIERS = 2

# Section captions by statement order.
PROFIT_LOSS_LABELS = (
    "REVENUE",
    "RETURNS",
    "REFUNDS",
    "OTHER REVENUE",
    "SUBSIDIES",
    "DISCOUNTS",
    "COST OF GOODS",
    "ADMIN EXPENSES",
    "SELLING EXPENSES",
    "OTHER EXPENSES",
    "OTHER INCOME",
    "INCOME TAX",
    "OTHER TAX",
)
BALANCE_SHEET_LABELS = (
    "CURRENT ASSETS",
    "FIXED ASSETS",
    "DEFERRED ASSETS",
    "CURRENT LIABILITIES",
    "LONG TERM LIABILITIES",
    "DEFERRED LIABILITIES",
    "EQUITY",
)

_ORDERS = "o_orderkey bigint, o_orderdate timestamp_ntz, o_orderpriority string"
_LINEITEM = (
    "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_extendedprice double"
)


def _company(supplier: str) -> str:
    return f"1 + {supplier} DIV {SUPPLIERS}"


def _sections(spark: SparkSession, path: str) -> DataFrame:
    """Every section of every company that has a supplier, and one that means no section.

    That one comes with company 1 and not from a union, so that a plan reads the suppliers once.
    """
    supplier = spark.read.schema("s_suppkey bigint").parquet(f"{path}/supplier.parquet")

    def section(identity: str, flag: int, company: str, order: int, label: str) -> str:
        values = (identity, str(flag), company, str(order), quoted(label))
        return row(**dict(zip(STATEMENT_SECTION, values)))

    sections = [
        section(f"company * 100 + {flag * 50 + order}", flag, "company", order, label)
        for flag, labels in enumerate((PROFIT_LOSS_LABELS, BALANCE_SHEET_LABELS))
        for order, label in enumerate(labels, start=1)
    ]
    sections.append(f"IF(company = 1, {section('0L', 0, '0L', 0, 'UNASSIGNED')}, NULL)")
    return (
        supplier.selectExpr(f"{_company('s_suppkey')} AS company")
        .where("company IS NOT NULL")
        .distinct()
        .selectExpr(f"inline(array_compact(array({', '.join(sections)})))")
        .selectExpr(*casts(STATEMENT_SECTION))
    )


def _accounts(section: DataFrame) -> DataFrame:
    return section.where("statement_section_id <> 0").selectExpr(
        "statement_section_id AS account_id",
        "statement_section_id * (1 - is_balance_sheet_section) AS profit_loss_section_id",
        "statement_section_id * is_balance_sheet_section AS balance_sheet_section_id",
    )


def _expand(lines: DataFrame) -> DataFrame:
    """One row per posting of an order line; a posting left out has no account."""
    nothing = f"CAST(NULL AS {AMOUNT})"
    part = "l_partkey % 13"
    postings = [
        row(
            account_id=f"IF(company = 2 AND {part} = 11, NULL, company * 100 + 1 + {part})",
            debit=f"IF(company = 1 AND {part} = 10, NULL, amount)",
            credit=nothing,
        ),
        row(account_id="company * 100 + 51 + l_partkey % 3", debit="amount", credit=nothing),
        row(
            account_id="IF(company = 5 AND l_linenumber = 1, NULL, "
            "company * 100 + 54 + l_suppkey % 4)",
            debit=nothing,
            credit="amount",
        ),
    ]
    source = {"l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"}
    keep = [name for name in lines.columns if name not in source]
    return (
        lines.selectExpr(
            *keep,
            "l_partkey",
            "l_suppkey",
            "l_linenumber",
            f"{_company('l_suppkey')} AS company",
            f"CAST(l_extendedprice AS {AMOUNT}) AS amount",
        )
        .selectExpr(*keep, f"inline(array({', '.join(postings)}))")
        .where("account_id IS NOT NULL")
    )


def ledger_from_orders(spark: SparkSession, path: str) -> Ledger:
    """Derive the ledger from the orders, lineitem and supplier tables in ``path``."""
    orders = spark.read.schema(_ORDERS).parquet(f"{path}/orders.parquet")
    lines = spark.read.schema(_LINEITEM).parquet(f"{path}/lineitem.parquet")
    entry = orders.selectExpr(
        "o_orderkey AS journal_entry_id",
        "CAST(o_orderdate AS date) AS entry_date",
        "CAST(IF(o_orderpriority = '5-LOW', 1, 0) AS tinyint) AS cancelled",
    )
    section = _sections(spark, path)
    return Ledger(
        account=_accounts(section),
        section=section,
        entry=entry,
        line=lines.withColumnRenamed("l_orderkey", "journal_entry_id"),
        expand=_expand,
        line_company=_company("l_suppkey"),
    )
