"""Five reports from one read of the balances."""

from decimal import Decimal as D

import pytest

from oracles import YEARS
from tallybook import operators as ops, plans
from tallybook.sources import read_section_balance, write_section_balance
from tests.ledgers import mart
from tests.test_random_ledgers import random_book


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_one_scan_of_the_balances(spark, tmp_path):
    ledger = random_book(8).ledger(spark)
    path = str(tmp_path / "mart")
    write_section_balance(ops.build_section_balance(ledger), path)
    stored = read_section_balance(spark, path)
    df = plans.all_reports(stored, ledger.section, YEARS)
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert {r.report for r in df.select("report").distinct().collect()} == set(plans.REPORTS)
    one = plans.all_reports(stored, ledger.section, YEARS, company_id=1)
    assert rows(one) == rows(df.where("company_id = 1")) != []


def test_the_parts_are_the_reports(spark):
    ledger = random_book(9).ledger(spark)
    balances = ops.build_section_balance(ledger).cache()
    got = plans.all_reports(balances, ledger.section, [1996, 1999]).cache()
    for report, alone in (
        ("pl_statement", plans.pl_statement(balances)),
        ("balance_sheet", plans.balance_sheet(balances)),
    ):
        part = got.where(f"report = '{report}'").drop("report", "change")
        assert rows(part) == rows(alone.where("year IN (1996, 1999)")) != []
    check = ops.balance_check(balances).where("year IN (1996, 1999)").selectExpr(
        "company_id", "year", "balance_check", "total_assets - total_liabilities_and_equity AS d"
    )
    part = got.where("report = 'balance_check'").select("company_id", "year", "line_label", "balance")
    assert rows(part) == rows(check) != []
    whole = plans.bs_year_over_year(balances, ledger.section, None, [1996, 1999])
    later = got.where("report = 'bs_year_over_year' AND year = 1999").select(
        "company_id", "line_order", "line_label", "balance", "change"
    )
    assert rows(later) == rows(whole.select("company_id", "line_order", "line_label", "b1999", "r96to99")) != []
    balances.unpersist()
    got.unpersist()


def test_two_balances_of_a_section_and_missing_ones(spark):
    ledger_rows = [
        (0, 1, 2016, 1, "REVENUE", D("10.00")),
        (0, 1, 2016, 1, "REVENUE", D("5.00")),
        (0, 1, 2016, 7, None, D("-3.00")),
        (0, 1, 2016, 2, "RETURNS", None),
        (1, 1, 2016, 1, "CASH", D("4.00")),
        (1, 1, None, 1, "CASH", D("9.00")),
        (1, None, 2016, 1, "CASH", D("9.00")),
    ]
    balances = mart(spark, ledger_rows)
    none = spark.createDataFrame(
        [], "statement_section_id bigint, is_balance_sheet_section tinyint, company_id int, "
        "statement_section_order int, statement_section string"
    )
    got = rows(plans.all_reports(balances, none, [2016]).where("report <> 'balance_sheet'").drop("change", "report"))
    alone = rows(plans.pl_statement(balances, 1, 2016))
    assert got == alone and len(alone) == 4 + 3 + 1
    assert rows(plans.all_reports(balances.where("false"), none, [2016])) == []
    with pytest.raises(ValueError):
        plans.all_reports(balances, none, [])
    with pytest.raises(ValueError):
        plans.all_reports(balances, none, [2016, 2016])
