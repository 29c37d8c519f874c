"""Spines and year-over-year reports on hand-written section balances."""

from decimal import Decimal as D

import pytest

from tallybook import schema
from tallybook.chart import STANDARD
from tallybook.operators import statement_spine
from tallybook.plans import (
    balance_sheet,
    bs_year_over_year,
    bs_year_over_year_formatted,
    pl_year_over_year,
    pl_year_over_year_formatted,
)
from tests.ledgers import frame, mart
from tests.test_statements import bs, pl, printed

SECTIONS = [
    (1, 0, 1, 1, "P1"),
    (2, 0, 1, 4, "P4"),
    (3, 0, 1, 12, "P12"),
    (4, 1, 1, 1, "B1"),
    (5, 1, 1, 4, "B4"),
    (6, 0, 2, 1, "P1"),
    (7, 0, 0, 0, "UNASSIGNED"),
]
YEARS = [2015, 2016, 2026]


def section(spark, rows=SECTIONS):
    return frame(spark, schema.STATEMENT_SECTION, rows)


def by_label(df):
    return {r.line_label: r for r in df.collect()}


def labels(df):
    return [r.line_label for r in df.orderBy("company_id", "line_order").collect()]


def test_spine(spark):
    s = section(spark, SECTIONS + [(8, 0, 1, 1, "P1"), (9, 2, 1, 9, "B9")])
    assert labels(statement_spine(s, 1, STANDARD.profit_loss)) == [
        "  P1", "  P4", "GROSS PROFIT", "PROFIT BEFORE TAXES", "  P12", "NET PROFIT",
    ]
    assert labels(statement_spine(s, 1, STANDARD.balance_sheet)) == [
        "ASSETS", "  B1", "TOTAL ASSETS", "", "LIABILITIES AND SHAREHOLDERS EQUITY", "  B4",
        "TOTAL LIABILITIES", "SHAREHOLDERS EQUITY", "TOTAL LIABILITIES AND SHAREHOLDERS EQUITY",
        "  B9",
    ]
    every = statement_spine(s, None, STANDARD.profit_loss).collect()
    assert sorted({r.company_id for r in every}) == [0, 1, 2]
    assert len(every) == len(set(every)) == 6 + 4 + 4


def test_spine_of_a_company_without_sections(spark):
    assert labels(statement_spine(section(spark), 9, STANDARD.profit_loss)) == [
        "GROSS PROFIT", "PROFIT BEFORE TAXES", "NET PROFIT",
    ]


def test_balances_and_ratios(spark):
    m = mart(
        spark,
        [pl(1, 100, 2015), pl(1, 150, 2016), pl(1, 75, 2026), pl(4, 10, 2016), pl(1, 9, 2020)],
    )
    rows = by_label(pl_year_over_year(m, section(spark), 1, YEARS))
    assert list(rows) == [
        "  P1", "  P4", "GROSS PROFIT", "PROFIT BEFORE TAXES", "  P12", "NET PROFIT",
    ]
    assert tuple(rows["  P1"])[3:] == (
        D("100.00"), D("150.00"), D("75.00"), D("0.500000"), D("-0.500000"),
    )
    # A missing base and a missing current year both print 0.
    assert tuple(rows["  P4"])[3:] == (D("0.00"), D("10.00"), D("0.00"), 0, 0)
    assert tuple(rows["  P12"])[3:] == (0, 0, 0, 0, 0)
    assert tuple(rows["NET PROFIT"])[3:6] == (D("100.00"), D("160.00"), D("75.00"))


def test_column_names_follow_the_years(spark):
    df = pl_year_over_year(mart(spark, []), section(spark), 1, [2009, 2010, 2026])
    assert df.columns[3:] == ["b2009", "b2010", "b2026", "r09to10", "r10to26"]
    with pytest.raises(ValueError):
        pl_year_over_year(mart(spark, []), section(spark), 1, [2015, 2015])


def test_missing_ratio_can_be_told_apart(spark):
    m = mart(spark, [pl(1, 0, 2015), pl(1, 50, 2016), pl(4, 5, 2015), pl(4, 5, 2016)])
    report = pl_year_over_year(m, section(spark), 1, [2015, 2016], missing_ratio=None)
    rows = by_label(report)
    assert rows["  P1"].r15to16 is None
    assert rows["  P4"].r15to16 == 0
    assert rows["  P12"].r15to16 is None


def test_negative_base_flips_the_sign(spark):
    m = mart(spark, [pl(1, -100, 2015), pl(1, -150, 2016)])
    rows = by_label(pl_year_over_year(m, section(spark), 1, [2015, 2016]))
    assert rows["  P1"].r15to16 == D("0.500000")


def test_repeated_section_gives_one_line_with_the_sum(spark):
    m = mart(spark, [f(4, b, y) for f in (pl, bs) for b in (7, 9) for y in (2015, 2016)])
    rows = pl_year_over_year(m, section(spark), 1, YEARS).collect()
    assert [r.b2016 for r in rows if r.line_label == "  P4"] == [D("16.00")]
    rows = bs_year_over_year(m, section(spark), 1, YEARS).collect()
    assert [r.b2016 for r in rows if r.line_label == "  B4"] == [D("-16.00")]
    assert len(rows) == 9


def test_same_label_at_two_orders_and_two_labels_at_one_order(spark):
    s = section(
        spark,
        [(1, 0, 1, 1, "SAME"), (2, 0, 1, 4, "SAME"), (3, 1, 1, 1, "X"), (4, 1, 1, 1, "Y")],
    )
    m = mart(
        spark,
        [pl(1, 5, 2015, label="SAME"), pl(4, 6, 2015, label="SAME"), bs(1, 7, 2015, label="X"),
         bs(1, 8, 2015, label="Y")],
    )
    rows = pl_year_over_year(m, s, 1, [2015, 2016]).collect()
    assert [r.b2015 for r in rows if r.line_label == "  SAME"] == [D("5.00"), D("6.00")]
    rows = by_label(bs_year_over_year(m, s, 1, [2015, 2016]))
    assert (rows["  X"].b2015, rows["  Y"].b2015) == (D("7.00"), D("8.00"))


def test_balance_without_a_label(spark):
    s = section(spark, [(1, 0, 1, 1, None), (2, 1, 1, 1, None)])
    m = mart(spark, [(0, 1, 2015, 1, None, D(5)), (1, 1, 2015, 1, None, D(7))])
    assert by_label(pl_year_over_year(m, s, 1, [2015, 2016]))[None].b2015 == 0
    assert by_label(bs_year_over_year(m, s, 1, [2015, 2016]))[None].b2015 == D("7.00")


def test_balance_sheet_captions_print_zeros(spark):
    m = mart(spark, [bs(1, 100, 2015), bs(4, -100, 2015)])
    rows = by_label(bs_year_over_year_formatted(m, section(spark), 1, [2015, 2016]))
    for caption in ("ASSETS", "", "LIABILITIES AND SHAREHOLDERS EQUITY", "SHAREHOLDERS EQUITY"):
        assert tuple(rows[caption])[3:] == ("0.00", "0.00", "0.00")
    assert rows["  B4"].b2015 == rows["TOTAL LIABILITIES"].b2015 == "100.00"


def test_formatted(spark):
    m = mart(spark, [pl(1, "-1234567.5", 2015), pl(1, "1234.005", 2016)])
    row = by_label(pl_year_over_year_formatted(m, section(spark), 1, [2015, 2016]))["  P1"]
    assert tuple(row)[3:] == ("-1,234,567.50", "1,234.01", "-1.00")


def test_lines_outside_the_spine_do_not_print(spark):
    m = mart(spark, [pl(1, 5, 2015, label="GONE"), pl(2, 5, 2015, company=3)])
    rows = pl_year_over_year(m, section(spark), None, [2015, 2016]).collect()
    assert {r.company_id for r in rows} == {0, 1, 2}
    assert "  GONE" not in {r.line_label for r in rows}
    assert {r.b2015 for r in rows if r.company_id == 1 and r.line_label == "NET PROFIT"} == {5}


def test_section_with_another_flag(spark):
    """The spine takes any non-zero flag, the balances only flag 1."""
    s = section(spark, [(1, 2, 1, 1, "B1")])
    m = mart(spark, [(2, 1, 2015, 1, "B1", D(5)), bs(2, 3, 2015)])
    rows = by_label(bs_year_over_year(m, s, 1, [2015, 2016]))
    assert rows["  B1"].b2015 == 0
    assert rows["TOTAL ASSETS"].b2015 == D("3.00")
    assert [line[0] for line in printed(balance_sheet(m, 1, 2015))][1] == "  B2"


def test_all_companies_equal_the_single_reports(spark):
    m = mart(spark, [f(o, o * c, y, c) for f in (pl, bs) for o in (1, 4) for c in (1, 2)
                     for y in (2015, 2016)])
    for report, companies in ((pl_year_over_year, (0, 1, 2)), (bs_year_over_year, (1,))):
        every = report(m, section(spark), None, YEARS).collect()
        singles = [r for c in companies for r in report(m, section(spark), c, YEARS).collect()]
        assert every == singles
