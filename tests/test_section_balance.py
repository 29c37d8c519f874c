"""The section balances on hand-written ledgers, one rule each."""

from datetime import date
from decimal import Decimal as D

import pytest

from tallybook.operators import bs_section_balance, build_section_balance, pl_section_balance
from tallybook.sources import Ledger
from tests.ledgers import book, frame, mart_rows

DAY = date(2016, 5, 4)
REVENUE = (101, 0, 1, 1, "REVENUE")
COST = (107, 0, 1, 7, "COST")
CASH = (151, 1, 1, 1, "CASH")
LOANS = (154, 1, 1, 4, "LOANS")


def test_signs_and_cancelled_entries(spark):
    b = book(
        [REVENUE, COST, CASH, LOANS],
        [(1, 101, 0), (2, 107, 0), (3, 0, 151), (4, 0, 154)],
        [
            (DAY, 1, D("10.25"), None),
            (DAY, 1, D("0.75"), None),
            (DAY, 2, D("4.00"), None),
            (DAY, 3, D("7.50"), D("2.00")),
            (DAY, 4, None, D("5.50")),
            (DAY, 1, D("99.00"), None),
            (date(2017, 1, 1), 1, D("1.00"), None),
        ],
        cancelled={5},
    )
    assert mart_rows(spark, b) == [
        (0, 1, 2016, 1, "REVENUE", D("11.00")),
        (0, 1, 2016, 7, "COST", D("-4.00")),
        (0, 1, 2017, 1, "REVENUE", D("1.00")),
        (1, 1, 2016, 1, "CASH", D("5.50")),
        (1, 1, 2016, 4, "LOANS", D("-5.50")),
    ]


def test_order_without_a_sign_has_a_null_balance(spark):
    b = book([(114, 0, 1, 14, "ODD")], [(1, 114, 0)], [(DAY, 1, D("5"), None)])
    assert mart_rows(spark, b) == [(0, 1, 2016, 14, "ODD", None)]


def test_credits_do_not_count_on_the_profit_and_loss_side(spark):
    b = book([REVENUE], [(1, 101, 0)], [(DAY, 1, None, D("100"))])
    assert mart_rows(spark, b) == [(0, 1, 2016, 1, "REVENUE", D("0.00"))]


@pytest.mark.parametrize("link", [0, None])
def test_account_without_a_profit_and_loss_link(spark, link):
    b = book(
        [REVENUE, CASH, (0, 0, 1, 3, "ZERO")], [(1, link, 151)], [(DAY, 1, D("5"), D("1"))]
    )
    assert mart_rows(spark, b) == [(1, 1, 2016, 1, "CASH", D("4.00"))]


def test_filters_of_the_two_sides_differ(spark):
    """A P&L link may point to an order-0 section, a balance-sheet link may not."""
    zero = (100, 0, 1, 0, "PLACEHOLDER")
    b = book([zero], [(1, 100, 100)], [(DAY, 1, D("5"), None)])
    assert mart_rows(spark, b) == [(0, 1, 2016, 0, "PLACEHOLDER", None)]


def test_balance_sheet_link_zero_follows_the_section_order(spark):
    b = book([(0, 1, 1, 2, "SECTION ZERO")], [(1, 0, 0)], [(DAY, 1, D("5"), None)])
    assert mart_rows(spark, b) == [(1, 1, 2016, 2, "SECTION ZERO", D("5.00"))]


def test_account_on_both_statements(spark):
    b = book([REVENUE, CASH], [(1, 101, 151)], [(DAY, 1, D("9"), D("2"))])
    assert mart_rows(spark, b) == [
        (0, 1, 2016, 1, "REVENUE", D("9.00")),
        (1, 1, 2016, 1, "CASH", D("7.00")),
    ]


def test_link_to_the_wrong_kind_keeps_the_flag_of_the_section(spark):
    b = book([CASH], [(1, 151, 0)], [(DAY, 1, D("9"), D("2"))])
    assert mart_rows(spark, b) == [(1, 1, 2016, 1, "CASH", D("9.00"))]


def test_section_reached_through_both_links_keeps_two_balances(spark):
    other = (104, 0, 1, 4, "OTHER REVENUE")
    b = book([other], [(1, 104, 104)], [(DAY, 1, D("9"), D("2"))])
    assert mart_rows(spark, b) == [
        (0, 1, 2016, 4, "OTHER REVENUE", D("7.00")),
        (0, 1, 2016, 4, "OTHER REVENUE", D("9.00")),
    ]


def test_equal_balances_through_both_links_collapse(spark):
    other = (104, 0, 1, 4, "OTHER REVENUE")
    b = book([other], [(1, 104, 0), (2, 0, 104)], [(DAY, 1, D("9"), None), (DAY, 2, D("9"), None)])
    assert mart_rows(spark, b) == [(0, 1, 2016, 4, "OTHER REVENUE", D("9.00"))]


def test_null_and_zero_balance_do_not_collapse(spark):
    odd = (114, 0, 1, 14, "ODD")
    b = book([odd], [(1, 114, 114)], [(DAY, 1, D("5"), D("5"))])
    assert mart_rows(spark, b) == [
        (0, 1, 2016, 14, "ODD", D("0.00")),
        (0, 1, 2016, 14, "ODD", None),
    ]


def test_sections_with_the_same_label_merge(spark):
    b = book(
        [REVENUE, (201, 0, 1, 1, "REVENUE")],
        [(1, 101, 0), (2, 201, 0)],
        [(DAY, 1, D("1"), None), (DAY, 2, D("2"), None)],
    )
    assert mart_rows(spark, b) == [(0, 1, 2016, 1, "REVENUE", D("3.00"))]


def test_entry_without_a_date_is_kept_without_a_year(spark):
    b = book([REVENUE], [(1, 101, 0)], [(None, 1, D("1"), None)])
    assert mart_rows(spark, b) == [(0, 1, None, 1, "REVENUE", D("1.00"))]


def test_lines_without_partner_disappear(spark):
    b = book([REVENUE], [(1, 101, 0), (2, 999, 0)], [(DAY, 1, D("1"), None)])
    b.journal_entry_line_item += [
        (77, 1, D("5"), None),  # no entry
        (0, 2, D("5"), None),  # no section
        (0, 3, D("5"), None),  # no account
        (0, None, D("5"), None),
        (None, 1, D("5"), None),
    ]
    assert mart_rows(spark, b) == [(0, 1, 2016, 1, "REVENUE", D("1.00"))]


def test_company_comes_from_the_section(spark):
    b = book(
        [REVENUE, (201, 0, 2, 1, "REVENUE")],
        [(1, 101, 0), (2, 201, 0)],
        [(DAY, 1, D("1"), None), (DAY, 2, D("2"), None)],
    )
    b.journal_entry_line_item[1] = (0, 2, D("2"), None)  # both lines in one entry
    assert mart_rows(spark, b) == [
        (0, 1, 2016, 1, "REVENUE", D("1.00")),
        (0, 2, 2016, 1, "REVENUE", D("2.00")),
    ]


def test_duplicate_master_rows_multiply_as_in_a_plain_join(spark):
    b = book([REVENUE, REVENUE], [(1, 101, 0), (1, 101, 0)], [(DAY, 1, D("1"), None)])
    b.journal_entry *= 2
    assert mart_rows(spark, b) == [(0, 1, 2016, 1, "REVENUE", D("8.00"))]


def test_balance_beyond_eighteen_digits(spark):
    most = D("9999999999999999.99")
    b = book([REVENUE, CASH], [(1, 101, 151)], [(DAY, 1, most, None)] * 3)
    assert mart_rows(spark, b) == [
        (0, 1, 2016, 1, "REVENUE", 3 * most),
        (1, 1, 2016, 1, "CASH", 3 * most),
    ]


def test_selected_years_equal_the_full_build(spark):
    days = [date(y, m, d) for y in (2014, 2015, 2016, 2018) for m, d in ((1, 1), (12, 31))]
    b = book([REVENUE], [(1, 101, 0)], [(day, 1, D("1"), None) for day in days])
    b.journal_entry.append((99, None, 0))
    b.journal_entry_line_item.append((99, 1, D("1"), None))
    full = [r for r in mart_rows(spark, b) if r[2] in (2015, 2018)]
    for build in (build_section_balance, pl_section_balance):
        some = build(b.ledger(spark), years=[2018, 2015])
        assert sorted(tuple(r) for r in some.collect()) == full
    assert bs_section_balance(b.ledger(spark), years=[2015]).collect() == []


def test_amounts_of_another_type_are_cast_before_they_are_summed(spark):
    b = book([REVENUE], [(1, 101, 0)], [(DAY, 1, None, None)])
    ledger = b.ledger(spark)
    columns = {**dict.fromkeys(("journal_entry_id", "account_id"), "bigint"), "debit": "double"}
    line = frame(spark, columns | {"credit": "double"}, [(0, 1, 0.29, None)] * 3)
    rows = build_section_balance(Ledger(ledger.account, ledger.section, ledger.entry, line))
    assert [r.balance for r in rows.collect()] == [D("0.87")]
