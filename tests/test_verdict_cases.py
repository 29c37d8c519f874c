"""Inputs and sessions that differ from the fixtures: scales, orders, charts, databases."""

import re
from dataclasses import replace
from decimal import Decimal as D

import pytest

from tallybook import operators as ops, plans, schema
from tallybook.chart import STANDARD
from tallybook.operators.balances import account_totals, posted_lines
from tallybook.operators.spine import bs_spine, pl_spine
from tallybook.session import cluster_settings
from tallybook.sources import (
    Ledger,
    ledger_from_reader,
    merge_ledgers,
    read_section_balance,
    write_section_balance,
)
from tests.ledgers import TABLES, book, mart, mart_rows
from tests.test_section_balance import CASH, DAY, LOANS, REVENUE


def stored(ledger: Ledger, **tables):
    """The ledger read as from a database whose tables are as given."""
    named = dict(zip(TABLES, (ledger.account, ledger.section, ledger.entry, ledger.line)))
    return ledger_from_reader(lambda name: tables.get(name, named[name]))


def one_account(spark, lines):
    """A ledger with one entry, one revenue account and these lines (debit, credit)."""
    ledger = book([REVENUE], [(1, 101, 0)], [(DAY, 1, D(0), None)]).ledger(spark)
    lines = lines.selectExpr("0L AS journal_entry_id", "1L AS account_id", "debit", "credit")
    return stored(ledger, journal_entry_line_item=lines)


@pytest.mark.parametrize("kind", ["decimal(18,4)", "decimal(38,10)", "double", "string"])
def test_fractions_of_a_cent_add_up(spark, kind):
    lines = spark.range(1000).selectExpr(f"CAST(0.0049 AS {kind}) AS debit", "NULL AS credit")
    (row,) = ops.build_section_balance(one_account(spark, lines)).collect()
    assert row.balance == D("4.90")


@pytest.mark.parametrize("kind", ["decimal(18,0)", "bigint", "decimal(20,2)"])
def test_amounts_with_more_digits(spark, kind):
    lines = spark.range(2).selectExpr(f"CAST(123456789012345678 AS {kind}) AS debit", "NULL AS credit")
    (row,) = ops.build_section_balance(one_account(spark, lines)).collect()
    assert row.balance == D("246913578024691356.00")


def test_many_of_the_largest_amounts(spark):
    most = "9999999999999999.99"
    lines = spark.range(10_000_000).selectExpr(
        f"CAST({most} AS decimal(18,2)) AS debit", "CAST(NULL AS decimal(18,2)) AS credit"
    )
    (row,) = ops.build_section_balance(one_account(spark, lines)).collect()
    assert row.balance == 10_000_000 * D(most)


def test_sums_are_refused_without_ansi(spark):
    ledger = book([REVENUE], [(1, 101, 0)], [(DAY, 1, D(1), None)]).ledger(spark)
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(ValueError, match="ansi"):
            account_totals(posted_lines(ledger))
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    assert cluster_settings(0)["spark.sql.ansi.enabled"] == "true"


@pytest.mark.parametrize("order", [10_000, 2**31 - 1])
def test_large_section_orders(spark, order):
    b = book(
        [REVENUE, (199, 0, 1, order, "FAR"), (198, 1, 1, order, "FAR")],
        [(1, 101, 0)],
        [(DAY, 1, D(7), None)],
    )
    ledger = b.ledger(spark)
    built = ops.build_section_balance(ledger)
    for spine, report in (
        (pl_spine(ledger.section, 1), plans.pl_year_over_year),
        (bs_spine(ledger.section, 1), plans.bs_year_over_year),
    ):
        assert D(order) in {r.line_order for r in spine.collect()}
        got = report(built, ledger.section, 1, [2015, 2016]).collect()
        assert D(order) in {r.line_order for r in got}


def _without(statement, captions, totals):
    return replace(
        statement,
        captions=() if captions else statement.captions,
        totals=() if totals else statement.totals,
    )


@pytest.mark.parametrize("captions, totals", [(True, False), (False, True), (True, True)])
def test_any_chart_of_lines(spark, captions, totals):
    chart = replace(
        STANDARD,
        profit_loss=_without(STANDARD.profit_loss, captions, totals),
        balance_sheet=_without(STANDARD.balance_sheet, captions, totals),
    )
    b = book(
        [REVENUE, CASH, LOANS],
        [(1, 101, 0), (3, 0, 151), (4, 0, 154)],
        [(DAY, 1, D(5), None), (DAY, 3, D(5), None), (DAY, 4, None, D(5))],
    )
    ledger = b.ledger(spark)
    built = ops.build_section_balance(ledger, chart)
    labels = lambda df: {r.line_label for r in df.collect()}
    for args in ((1, 2016), (None, None)):
        assert "  REVENUE" in labels(plans.pl_statement(built, *args, chart=chart))
        sheet = labels(plans.balance_sheet(built, *args, chart=chart))
        assert {"  CASH", "  LOANS"} <= sheet
        assert ("ASSETS" in sheet) != captions and ("TOTAL ASSETS" in sheet) != totals
        assert labels(plans.balance_sheet_formatted(built, *args, chart=chart)) == sheet
    assert (ops.pl_subtotals(built, chart).count() == 0) == totals
    assert (ops.bs_totals(built, chart).count() == 0) == totals
    for company in (1, None):
        lines = labels(plans.pl_year_over_year(built, ledger.section, company, [2015, 2016], chart))
        assert ("NET PROFIT" in lines) != totals and "  REVENUE" in lines
        lines = labels(plans.bs_year_over_year(built, ledger.section, company, [2015, 2016], chart))
        assert ("ASSETS" in lines) != captions and "  CASH" in lines


def test_overwrite_is_static(spark, tmp_path):
    path = str(tmp_path / "mart")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        for year in (2015, 2016):
            write_section_balance(mart(spark, [(0, 1, year, 1, "R", D(1))]), path)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert [r.year for r in read_section_balance(spark, path).collect()] == [2016]


def test_databases_with_equal_ids(spark):
    first = book(
        [REVENUE, CASH], [(1, 101, 0), (3, 0, 151), (9, 0, 0)],
        [(DAY, 1, D("1.50"), None), (DAY, 3, D(2), D("0.25")), (DAY, 9, D(9), None)],
    )
    second = book(
        [REVENUE, CASH], [(1, 0, 151), (3, 101, 0)],
        [(DAY, 1, D(30), None), (DAY, 3, D(4), None), (DAY, 3, D(8), None)], cancelled={2},
    )
    both = merge_ledgers({0: first.ledger(spark), 7: second.ledger(spark)})
    got = {(r.is_balance_sheet_section, r.year): r.balance for r in ops.build_section_balance(both).collect()}
    assert got == {(0, 2016): D("5.50"), (1, 2016): D("31.75")}
    apart = mart_rows(spark, first) + mart_rows(spark, second)
    assert sum(r[-1] for r in apart) == sum(got.values())


def test_merging_refuses_what_it_cannot_keep_apart(spark):
    ledger = book([REVENUE], [(1, 101, 0)], [(DAY, 1, D(1), None)]).ledger(spark)
    for bad in ({}, {-1: ledger}, {1 << 16: ledger}):
        with pytest.raises(ValueError):
            merge_ledgers(bad)
    wide = book([REVENUE], [(1 << 47, 101, 0)], []).ledger(spark)
    with pytest.raises(Exception, match="47 bits"):
        merge_ledgers({1: wide}).account.collect()


def test_one_company_is_pruned_before_the_join(spark):
    other = (201, 0, 2, 1, "REVENUE")
    b = book(
        [REVENUE, other], [(1, 101, 0), (2, 201, 0)],
        [(DAY, 1, D(3), None), (DAY, 2, D(4), None)],
    )
    ledger = b.ledger(spark)
    built = ops.build_section_balance(ledger, company_id=2)
    assert [(r.company_id, r.balance) for r in built.collect()] == [(2, D(4))]
    plan = posted_lines(ledger, company_id=2)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join Inner") < plan.index("Join LeftSemi")
    told = replace(ledger, line_company="account_id")
    assert [r.balance for r in ops.build_section_balance(told, company_id=2).collect()] == [D(4)]


def test_names_of_years_of_two_centuries(spark):
    ledger = book([REVENUE], [(1, 101, 0)], [(DAY, 1, D(1), None)]).ledger(spark)
    built = ops.build_section_balance(ledger)
    years = [1915, 1916, 2015, 2016]
    names = plans.pl_year_over_year(built, ledger.section, 1, years).columns
    assert len(set(names)) == len(names) and "r1915to1916" in names and "r2015to2016" in names
    for call in (
        lambda: plans.pl_year_over_year(built, ledger.section, 1, []),
        lambda: ops.build_section_balance(ledger, years=[]),
    ):
        with pytest.raises(ValueError, match="years"):
            call()


@pytest.mark.parametrize("kind", ["int", "bigint", "tinyint"])
def test_cancelled_reaches_the_scan(spark, tmp_path, kind):
    path = str(tmp_path / "entry")
    entry = spark.sql(f"SELECT 0L AS journal_entry_id, DATE'{DAY}' AS entry_date, CAST(0 AS {kind}) AS cancelled")
    entry.write.parquet(path)
    ledger = book([REVENUE], [(1, 101, 0)], [(DAY, 1, D(6), None)]).ledger(spark)
    read = stored(ledger, journal_entry=spark.read.parquet(path))
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = posted_lines(read)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert re.search(r"PushedFilters: \[[^]]*EqualTo\(cancelled,0\)", plan)
    assert [r.balance for r in ops.build_section_balance(read).collect()] == [D(6)]


def test_partitions_stay_small_at_a_hundred_terabytes():
    settings = cluster_settings(10**14)
    per_partition = 10**14 / int(settings["spark.sql.shuffle.partitions"])
    assert per_partition <= 400 * 2**20
    assert int(settings["spark.sql.files.maxPartitionBytes"]) <= 2**30
    assert settings["spark.sql.session.timeZone"] == "UTC"


def test_conforming_keeps_other_types(spark):
    df = spark.sql("SELECT 1.5D AS journal_entry_id, 2 AS account_id, 1BD AS debit, 2S AS credit")
    types = dict(schema.conform(df, schema.JOURNAL_ENTRY_LINE_ITEM).dtypes)
    assert types == {
        "journal_entry_id": "bigint", "account_id": "bigint",
        "debit": "decimal(18,2)", "credit": "decimal(18,2)",
    }
