"""Digests of journals and balances, against the rows themselves."""

import random
from collections import Counter, defaultdict
from copy import deepcopy
from datetime import date
from decimal import Decimal as D

import pytest

from tallybook import operators as ops
from tallybook.schema import DIGEST
from tallybook.sources import (
    ledger_from_clustered,
    read_digest,
    save_clustered_journal,
    write_digest,
)
from tests.ledgers import Book, book, frame, mart
from tests.test_random_ledgers import random_book
from tests.test_section_balance import CASH, REVENUE
from tests.test_upkeep import random_change, touched

ACCOUNTS = [(1, 101, 0), (3, 0, 151)]
CENT = D("0.01")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def states(stored, found):
    return {tuple(r)[:2]: tuple(r)[2:] for r in ops.reconcile(stored, found).collect()}


def lines_by_period(b: Book) -> dict:
    """The lines behind the balances of every company-year, counted one by one."""
    sections = defaultdict(list)
    for s in b.statement_section:
        sections[s[0]].append(s)
    owners = defaultdict(set)
    for account, pl, bs in b.account:
        owners[account] |= {s[2] for s in sections[pl] if pl}
        owners[account] |= {s[2] for s in sections[bs] if s[3]}
    entries = defaultdict(list)
    for entry, day, cancelled in b.journal_entry:
        if cancelled == 0:
            entries[entry].append(day and day.year)
    found = defaultdict(Counter)
    for line in b.journal_entry_line_item:
        for year in entries[line[0]]:
            for company in owners[line[1]]:
                found[company, year][line] += 1
    return found


def wanted(old: Book, new: Book) -> dict:
    was, now = lines_by_period(old), lines_by_period(new)
    found = {}
    for key in was.keys() | now.keys():
        a, b = was.get(key, Counter()), now.get(key, Counter())
        state = "not stored" if not a else "not found" if not b else "same" if a == b else "changed"
        found[key] = (a.total(), b.total(), state)
    return found


@pytest.mark.parametrize("seed", range(2))
def test_random_changes_are_found_where_they_are(spark, seed):
    old = random_book(seed)
    new, ids = random_change(random.Random(seed), old)
    before, after = (ops.journal_digest(b.ledger(spark)).cache() for b in (old, new))
    got = states(before, after)
    assert got == wanted(old, new)
    assert {s for *_, s in got.values()} >= {"same", "changed"}
    # The change alone brings the one digest to the other.
    sides = touched(old, new, ids)
    for side in sides:
        side.account, side.statement_section = old.account, old.statement_section
    sides = [ops.journal_digest(b.ledger(spark)) for b in sides]
    assert rows(ops.merge_digests(before, ops.change_digest(*sides))) == rows(after)


def two_years():
    postings = [(date(y, 3, n), a, D(n), None) for y in (1995, 1996) for n in (1, 2) for a in (1, 3)]
    return book([REVENUE, CASH], ACCOUNTS, postings)


def changed(edit) -> Book:
    new = deepcopy(two_years())
    edit(new.journal_entry_line_item)
    return new


@pytest.mark.parametrize(
    "edit, found",
    [
        (lambda x: None, (4, 4, "same")),
        (lambda x: x.reverse(), (4, 4, "same")),
        (lambda x: x.append(x[0]), (4, 5, "changed")),
        (lambda x: x.extend([x[0], x[0]]), (4, 6, "changed")),
        (lambda x: x.pop(0), (4, 3, "changed")),
        (lambda x: x.__setitem__(0, (*x[0][:2], x[0][2] + CENT, None)), (4, 4, "changed")),
        # Debit and credit exchanged, and a line moved to another entry of the day.
        (lambda x: x.__setitem__(0, (*x[0][:2], None, x[0][2])), (4, 4, "changed")),
        (lambda x: x.__setitem__(0, (1, *x[0][1:])), (4, 4, "changed")),
        # Two cents that leave every balance as it was.
        (lambda x: x.__setitem__(slice(0, 3), [(*x[0][:2], x[0][2] + CENT, None), x[1],
                                               (*x[2][:2], x[2][2] - CENT, None)]), (4, 4, "changed")),
        (lambda x: x.__setitem__(slice(0, 4), []), (4, 0, "not found")),
    ],
)
def test_one_change(spark, edit, found):
    before, after = (ops.journal_digest(b.ledger(spark)) for b in (two_years(), changed(edit)))
    company = REVENUE[2]
    assert states(before, after) == {(company, 1995): found, (company, 1996): (4, 4, "same")}


def test_parts_add_up(spark):
    whole, part = random_book(3), []
    for odd in (0, 1):
        half = deepcopy(whole)
        half.journal_entry_line_item = whole.journal_entry_line_item[odd::2]
        part.append(ops.journal_digest(half.ledger(spark)))
    assert rows(ops.merge_digests(*part)) == rows(ops.journal_digest(whole.ledger(spark)))
    with pytest.raises(ValueError, match="no digests"):
        ops.merge_digests()


def test_years_and_companies(spark):
    ledger = random_book(1).ledger(spark)
    all_of = ops.journal_digest(ledger).cache()
    assert rows(ops.journal_digest(ledger, years=[1995, 1996])) == rows(
        all_of.where("year IN (1995, 1996)")
    )
    company = all_of.where("company_id IS NOT NULL").first().company_id
    assert rows(ops.journal_digest(ledger, company_id=company)) == rows(
        all_of.where(f"company_id = {company}")
    )


def test_however_the_journal_is_stored(spark, tmp_path):
    ledger = random_book(2).ledger(spark)
    save_clustered_journal(ledger, str(tmp_path / "clustered"), files=3)
    stored = ledger_from_clustered(spark, ledger, str(tmp_path / "clustered"))
    assert rows(ops.journal_digest(stored)) == rows(ops.journal_digest(ledger))


def test_stored_digest(spark, tmp_path):
    path = str(tmp_path / "digest")
    digest = ops.journal_digest(random_book(0).ledger(spark)).cache()
    write_digest(digest, path)
    back = read_digest(spark, path)
    assert back.columns == list(DIGEST)
    assert {s for *_, s in states(back, digest).values()} == {"same"}


def test_balances(spark):
    balances = [
        (1, 1, 1995, 1, "CASH", D(5)),
        (1, 1, 1995, 1, "CASH", D(5)),
        (1, 1, 1996, 1, None, None),
        (1, 2, None, 1, "CASH", D(7)),
        (0, 3, 1995, 1, "SALES", D(7)),
    ]
    now = [balances[0], balances[2], (1, 2, None, 1, "CASH", D("7.01")), (1, 4, 1995, 1, "", D(0))]
    before, after = (ops.balance_digest(mart(spark, m)) for m in (balances, now))
    assert states(before, after) == {
        (1, 1995): (2, 1, "changed"),
        (1, 1996): (1, 1, "same"),
        (2, None): (1, 1, "changed"),
        (3, 1995): (1, 0, "not found"),
        (4, 1995): (0, 1, "not stored"),
    }


def test_nulls_are_told_apart(spark):
    """A NULL and a value exchanged, and an empty label against none."""
    one = [(0, 1, 1995, 1, None, D(1)), (0, 2, 1995, None, "", D(1)), (0, 3, 1995, 1, "", None)]
    two = [(0, 1, 1995, None, None, D(1)), (0, 2, 1995, None, None, D(1)), (0, 3, 1995, 1, None, D(0))]
    got = states(*(ops.balance_digest(mart(spark, m)) for m in (one, two)))
    assert {s for *_, s in got.values()} == {"changed"}


def test_empty(spark):
    none, some = Book().ledger(spark), two_years().ledger(spark)
    nothing = ops.journal_digest(none)
    assert rows(nothing) == []
    assert states(nothing, nothing) == {}
    assert {s for *_, s in states(nothing, ops.journal_digest(some)).values()} == {"not stored"}
    assert rows(ops.balance_digest(mart(spark, []))) == []


def test_sums_of_very_many_rows(spark):
    """Digests of 10^13 rows still merge without an overflow."""
    large = (1, 1995, 10**13, *[10**13 * (2**16 - 1)] * 4)
    digest = frame(spark, DIGEST, [large])
    merged = ops.merge_digests(digest, digest)
    assert rows(merged) == [(1, 1995, *[2 * x for x in large[2:]])]
    assert states(digest, digest) == {(1, 1995): (10**13, 10**13, "same")}


def test_the_two_sides_are_not_joined(spark):
    stored = frame(spark, DIGEST, [(1, 1995, 1, 2, 3, 4, 5)])
    plan = ops.reconcile(stored, stored)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
