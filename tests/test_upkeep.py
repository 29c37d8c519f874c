"""Balances kept up to date from changes, against rebuilds."""

import random
from copy import deepcopy
from datetime import date
from decimal import Decimal as D

import pytest

from tallybook import operators as ops
from tallybook.sources import ledger_from_files
from tests.ledgers import Book, book
from tests.test_plans import save_as_files
from tests.test_random_ledgers import random_book
from tests.test_section_balance import CASH, REVENUE

ACCOUNTS = [(1, 101, 0), (3, 0, 151)]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def touched(old: Book, new: Book, ids) -> tuple[Book, Book]:
    """Everything about some entries, as it was and as it is."""
    return tuple(
        Book(
            journal_entry=[e for e in b.journal_entry if e[0] in ids],
            journal_entry_line_item=[x for x in b.journal_entry_line_item if x[0] in ids],
        )
        for b in (old, new)
    )


def changed(spark, old: Book, new: Book, ids):
    before, after = touched(old, new, ids)
    return ops.change_totals(before.ledger(spark), after.ledger(spark))


def random_change(rng: random.Random, old: Book) -> tuple[Book, set]:
    """Entries are cancelled, revived, dated anew, added and deleted, lines come, go and change."""
    new, ids = deepcopy(old), set()
    amount = lambda: rng.choice([None, D(0), D(rng.randint(-(10**7), 10**9)) / 100])
    for i in rng.sample(range(len(new.journal_entry)), 25):
        entry, day, cancelled = new.journal_entry[i]
        kind = rng.randrange(3)
        if kind == 0:
            new.journal_entry[i] = (entry, day, 0 if cancelled else 1)
        elif kind == 1:
            new.journal_entry[i] = (entry, rng.choice([None, date(rng.randint(1994, 2002), 5, 5)]), cancelled)
        ids.add(entry)
    gone = {e[0] for e in rng.sample(new.journal_entry, 6)}
    new.journal_entry = [e for e in new.journal_entry if e[0] not in gone]
    ids |= gone
    fresh = max(e[0] for e in old.journal_entry) + 1 + rng.randrange(5)
    new.journal_entry.append((fresh, date(1999, 1, 1), 0))
    ids.add(fresh)
    kept = []
    for line in new.journal_entry_line_item:
        if line[0] in ids and rng.random() < 0.3:
            if rng.random() < 0.5:
                continue
            line = (line[0], rng.randint(-1, 85), amount(), amount())
        kept.append(line)
    kept += [(fresh, rng.randint(0, 80), amount(), amount()) for _ in range(5)]
    new.journal_entry_line_item = kept
    return new, ids


@pytest.mark.parametrize("seed", range(2))
def test_any_sequence_of_changes_equals_a_rebuild(spark, seed):
    rng = random.Random(seed)
    books, changes = [random_book(seed)], []
    for _ in range(3):
        new, ids = random_change(rng, books[-1])
        changes.append(changed(spark, books[-1], new, ids).cache())
        books.append(new)
    first = ops.kept_totals(books[0].ledger(spark)).cache()
    wanted = [rows(ops.build_section_balance(b.ledger(spark))) for b in books]
    assert len({repr(w) for w in wanted}) == 4
    one_by_one = first
    for change, expected, b in zip(changes, wanted[1:], books[1:], strict=True):
        one_by_one = ops.merge_totals(one_by_one, change)
        assert rows(ops.maintained_balances(one_by_one, b.ledger(spark))) == expected
        # What is kept is what a first load would keep.
        assert rows(one_by_one) == rows(ops.kept_totals(b.ledger(spark)))
    shuffled = ops.merge_totals(first, *rng.sample(changes, 3))
    assert rows(ops.maintained_balances(shuffled, books[-1].ledger(spark))) == wanted[-1]


def test_a_group_without_lines_disappears_and_one_without_amounts_is_null(spark):
    old = book([REVENUE, CASH], ACCOUNTS, [(date(2015, 1, 1), 1, D(5), None), (date(2016, 1, 1), 1, None, None),
                                           (date(2016, 1, 1), 1, D("0.01"), None)])
    new = deepcopy(old)
    new.journal_entry[0] = (0, date(2015, 1, 1), 1)
    new.journal_entry[2] = (2, date(2016, 1, 1), 1)
    kept = ops.merge_totals(ops.kept_totals(old.ledger(spark)), changed(spark, old, new, {0, 2}))
    assert rows(kept) == [(1, 2016, None, None, 1, 0, 0)]
    assert rows(ops.maintained_balances(kept, new.ledger(spark))) == rows(
        ops.build_section_balance(new.ledger(spark))
    )


def test_what_is_taken_back_twice_is_refused(spark):
    old = book([REVENUE], ACCOUNTS, [(date(2015, 1, 1), 1, D(5), None)])
    new = book([REVENUE], ACCOUNTS, [])
    change = changed(spark, old, new, {0})
    with pytest.raises(Exception, match="account 1, year 2015"):
        ops.merge_totals(ops.kept_totals(old.ledger(spark)), change, change).collect()


def test_new_links_and_no_change_need_no_journal(spark, tmp_path):
    """Nothing of the journal is in the plan: balances come from the stored totals."""
    b = book([REVENUE, CASH], ACCOUNTS, [(date(2015, 1, 1), 1, D(5), D(2)), (None, 3, D(1), None)])
    save_as_files(spark, b.ledger(spark), str(tmp_path / "ledger"))
    ledger = ledger_from_files(spark, str(tmp_path / "ledger"))
    ops.kept_totals(ledger).write.parquet(str(tmp_path / "kept"))
    kept = spark.read.parquet(str(tmp_path / "kept"))
    empty = book([], [], []).ledger(spark)
    merged = ops.merge_totals(kept, ops.change_totals(empty, empty))
    got = ops.maintained_balances(merged, ledger)
    assert rows(got) == rows(ops.build_section_balance(ledger))
    read = " ".join(got.inputFiles())
    assert "kept" in read and "journal_entry" not in read
    b.account[0] = (1, 0, 151)
    assert rows(ops.maintained_balances(kept, b.ledger(spark))) == rows(
        ops.build_section_balance(b.ledger(spark))
    )
