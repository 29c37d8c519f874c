"""The printed reports."""

from tallybook.plans.all_reports import REPORTS, all_reports
from tallybook.plans.statements import (
    balance_sheet,
    balance_sheet_formatted,
    pl_statement,
    pl_statement_formatted,
)
from tallybook.plans.year_over_year import (
    bs_year_over_year,
    bs_year_over_year_formatted,
    pl_year_over_year,
    pl_year_over_year_formatted,
)

__all__ = [
    "REPORTS",
    "all_reports",
    "balance_sheet",
    "balance_sheet_formatted",
    "bs_year_over_year",
    "bs_year_over_year_formatted",
    "pl_statement",
    "pl_statement_formatted",
    "pl_year_over_year",
    "pl_year_over_year_formatted",
]
