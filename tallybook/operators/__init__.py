"""From journal lines to section balances, and the sums over section balances."""

from tallybook.operators.audit import entry_differences, largest_differences
from tallybook.operators.balances import (
    account_totals,
    bs_section_balance,
    build_section_balance,
    pl_section_balance,
    posted_lines,
)
from tallybook.operators.digest import (
    balance_digest,
    change_digest,
    journal_digest,
    merge_digests,
    reconcile,
)
from tallybook.operators.spine import statement_spine
from tallybook.operators.totals import (
    balance_check,
    balance_check_prefix,
    bs_totals,
    gross_margin_ratio,
    pl_subtotals,
)
from tallybook.operators.upkeep import (
    change_totals,
    kept_totals,
    maintained_balances,
    merge_totals,
)

__all__ = [
    "account_totals",
    "balance_check",
    "balance_check_prefix",
    "balance_digest",
    "bs_section_balance",
    "bs_totals",
    "build_section_balance",
    "change_digest",
    "change_totals",
    "entry_differences",
    "gross_margin_ratio",
    "journal_digest",
    "kept_totals",
    "largest_differences",
    "maintained_balances",
    "merge_digests",
    "merge_totals",
    "pl_section_balance",
    "pl_subtotals",
    "posted_lines",
    "reconcile",
    "statement_spine",
]
