"""Whether a journal, or its balances, still hold the rows they held, without a join of the two.

The digest of a company-year is the number of its rows and the sums of their hashes, by 16 bits
each. It does not depend on the order of the rows, a row that repeats counts as often as it is
there, and digests of parts add up to the digest of the whole: they are combined before the
shuffle, merged with those of other loads, and changed by what came and went. Stored beside the
balances, the digest of the journal tells later whether a rebuild would read the same lines.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tallybook.functions import row
from tallybook.operators.balances import PL_LINK, joined_lines, require_ansi
from tallybook.schema import AMOUNT, DIGEST, SECTION_BALANCE, casts, conform, with_amounts
from tallybook.sources.ledger import Ledger

_PERIOD = ["company_id", "year"]
_SUMS = [name for name in DIGEST if name not in _PERIOD]
#: Bits of a hash that one sum takes: it holds the sums of 2^47 rows.
_BITS = 16


def _digest(rows: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Number and sums of the rows by ``keys``, hashed over ``columns``."""
    require_ansi(rows.sparkSession)
    # The hash skips NULLs, so it also takes which columns are NULL.
    nulls = " + ".join(f"IF({name} IS NULL, {1 << i}, 0)" for i, name in enumerate(columns))
    hashed = rows.selectExpr(*keys, f"xxhash64({', '.join(columns)}, {nulls}) AS hash")
    parts = [
        F.expr(f"sum(shiftrightunsigned(hash, {_BITS * i}) & {(1 << _BITS) - 1}L)").alias(name)
        for i, name in enumerate(_SUMS[1:])
    ]
    return hashed.groupBy(*keys).agg(F.count("*").alias(_SUMS[0]), *parts)


def _companies(ledger: Ledger, company_id: int | None) -> DataFrame:
    """The companies in whose balances the lines of an account are."""
    section = ledger.section
    # As in with_sections: not broadcast if there are many, whose sums are not those of one company.
    shuffled = company_id is None and ledger.gather is not None
    if shuffled:
        section = section.hint("merge")
    elif company_id is not None:
        section = section.where(f"company_id = {int(company_id)}")
    pl = row(is_pl="true", statement_section_id=PL_LINK)
    bs = row(is_pl="false", statement_section_id="balance_sheet_section_id")
    companies = (
        ledger.account.selectExpr("account_id", f"inline(array({pl}, {bs}))")
        .join(section, "statement_section_id")
        .where("is_pl OR statement_section_order != 0")
        .select("account_id", "company_id")
        .distinct()
    )
    return companies.hint("merge") if shuffled else companies


def journal_digest(
    ledger: Ledger, years: Sequence[int] | None = None, company_id: int | None = None
) -> DataFrame:
    """The digest of the lines behind the balances of every company-year.

    A line counts with its entry, account, year, debit and credit, if its entry is live and its
    account has a section; in each company, if there are several. However the journal is stored,
    the digest is the same, as long as its amounts have the same type.

    One pass over the journal: the lines are summed per (account, year) before they meet the
    accounts, as for the balances.
    """
    postings = ledger.postings(joined_lines(ledger, years, company_id))
    amounts = casts(with_amounts(postings, {"debit": AMOUNT, "credit": AMOUNT}))
    columns = ["journal_entry_id", "account_id", "year", "debit", "credit"]
    by_account = _digest(
        postings.selectExpr(*columns[:3], *amounts), ["account_id", "year"], columns
    )
    return merge_digests(by_account.join(_companies(ledger, company_id), "account_id"))


def balance_digest(mart: DataFrame) -> DataFrame:
    """The digest of the section balances of every company-year."""
    return _digest(conform(mart, SECTION_BALANCE), _PERIOD, list(SECTION_BALANCE))


def change_digest(before: DataFrame, after: DataFrame) -> DataFrame:
    """What to merge into a digest when rows with the digest ``before`` become others.

    Its numbers may be negative. As in ``change_totals``, both sides hold what the change touches,
    but with their accounts and sections, which tell the companies.
    """
    return merge_digests(after, before.selectExpr(*_PERIOD, *[f"-{x} AS {x}" for x in _SUMS]))


def merge_digests(*digests: DataFrame) -> DataFrame:
    """The digest of all rows together; company-years without any row are gone."""
    if not digests:
        raise ValueError("no digests to merge")
    parts = digests[0].select(*DIGEST)
    for digest in digests[1:]:
        parts = parts.unionByName(digest.select(*DIGEST))
    merged = parts.groupBy(*_PERIOD).agg(*[F.sum(name).alias(name) for name in _SUMS])
    return merged.where(" OR ".join(f"{name} <> 0" for name in _SUMS))


def reconcile(stored: DataFrame, found: DataFrame) -> DataFrame:
    """company_id, year, n_stored, n_found, state for every company-year of two digests.

    The state is "same", "changed", "not found" (stored only) or "not stored" (found only). The
    two are not joined: their rows, one for each company-year, meet in one aggregation. Two states
    of different rows pass as the same only if their 64-bit hashes collide.
    """
    sides = stored.selectExpr(*DIGEST, "false AS is_found").unionByName(
        found.selectExpr(*DIGEST, "true AS is_found")
    )
    same = " AND ".join(f"sum(IF(is_found, {name}, -{name})) = 0" for name in _SUMS)
    return (
        sides.groupBy(*_PERIOD)
        .agg(
            F.expr("sum(IF(is_found, 0, n_rows)) AS n_stored"),
            F.expr("sum(IF(is_found, n_rows, 0)) AS n_found"),
            F.expr(
                "CASE WHEN bool_and(is_found) THEN 'not stored' "
                f"WHEN NOT bool_or(is_found) THEN 'not found' WHEN {same} THEN 'same' "
                "ELSE 'changed' END AS state"
            ),
        )
        .select(*_PERIOD, "n_stored", "n_found", "state")
    )
