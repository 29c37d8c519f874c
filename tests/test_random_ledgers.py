"""Random ledgers with every awkward case, against the oracle SQL."""

import random
from datetime import date
from decimal import Decimal as D

import duckdb
import pytest

import oracles
from oracles import BS_YEAR, COMPANY, PL_YEAR, YEARS
from tallybook import operators as ops, plans
from tests.compare import assert_same
from tests.ledgers import Book


def random_book(seed: int) -> Book:
    rng = random.Random(seed)
    sections = [(0, 0, 0, 0, "UNASSIGNED")]
    for section_id in range(1, 60):
        flag = rng.choice([0, 0, 1])
        order = rng.choice([0, *range(1, 16)]) if flag == 0 else rng.randint(0, 9)
        label = rng.choice([f"L{order}", f"L{order}", f"S{section_id % 7}"])
        sections.append((section_id, flag, rng.choice([1, 1, 2, None]), order, label))
    links = [None, 0, 0, *range(1, 60), 77]
    accounts = [(i, rng.choice(links), rng.choice(links)) for i in range(80)]
    days = [None] + [date(y, rng.randint(1, 12), rng.randint(1, 28)) for y in range(1994, 2003)]
    entries = [(i, rng.choice(days), rng.choice([0, 0, 0, 1, None])) for i in range(200)]

    def amount():
        return rng.choice([None, D(0), D(rng.randint(-10**7, 10**9)) / 100])

    lines = [
        (rng.choice([None, *range(210)]), rng.randint(-1, 85), amount(), amount())
        for _ in range(1500)
    ]
    return Book(accounts, sections, entries, lines)


def reports(ledger, mart):
    section = ledger.section
    yield "pl_section_balance", ops.pl_section_balance(ledger)
    yield "bs_section_balance", ops.bs_section_balance(ledger)
    yield "section_balance", mart
    yield "pl_subtotals", ops.pl_subtotals(mart)
    yield "bs_totals", ops.bs_totals(mart)
    yield "gross_margin_ratio", ops.gross_margin_ratio(mart)
    yield "balance_check", ops.balance_check(mart)
    yield "balance_check_prefix", ops.balance_check_prefix(mart)
    yield "pl_statement", plans.pl_statement(mart, COMPANY, PL_YEAR)
    yield "pl_statement_all", plans.pl_statement(mart)
    yield "pl_statement_formatted", plans.pl_statement_formatted(mart, COMPANY, PL_YEAR)
    yield "balance_sheet", plans.balance_sheet(mart, COMPANY, BS_YEAR)
    yield "balance_sheet_all", plans.balance_sheet(mart)
    yield "balance_sheet_formatted", plans.balance_sheet_formatted(mart, COMPANY, BS_YEAR)
    yield "all_reports", plans.all_reports(mart, section, YEARS)
    for kind in ("pl", "bs"):
        report = getattr(plans, f"{kind}_year_over_year")
        text = getattr(plans, f"{kind}_year_over_year_formatted")
        yield f"{kind}_year_over_year", report(mart, section, COMPANY, YEARS)
        yield f"{kind}_year_over_year_all", report(mart, section, None, YEARS)
        yield f"{kind}_year_over_year_formatted", text(mart, section, COMPANY, YEARS)


@pytest.mark.parametrize("seed", range(3))
def test_random_ledger(spark, seed):
    book = random_book(seed)
    con = duckdb.connect()
    book.load(con)
    ledger = book.ledger(spark)
    mart = ops.build_section_balance(ledger).cache()
    rows = mart.collect()
    keys = {tuple(r)[:5] for r in rows}
    assert len(rows) > len(keys) > 100, "no section is reached through both links"
    assert {r.year is None for r in rows} == {r.balance is None for r in rows} == {True, False}
    for key, df in reports(ledger, mart):
        try:
            assert_same(df, con, oracles.on_ledger_tables(key))
        except AssertionError as error:
            raise AssertionError(f"{key}: {error}") from error
    mart.unpersist()
