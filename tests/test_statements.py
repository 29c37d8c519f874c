"""Totals, statements and the identity check on hand-written section balances."""

from decimal import Decimal as D

from tallybook.operators import (
    balance_check,
    balance_check_prefix,
    bs_totals,
    gross_margin_ratio,
    pl_subtotals,
)
from tallybook.plans import (
    balance_sheet,
    balance_sheet_formatted,
    pl_statement,
    pl_statement_formatted,
)
from tests.ledgers import mart

GROSS, BEFORE_TAXES, NET = "GROSS PROFIT", "PROFIT BEFORE TAXES", "NET PROFIT"
MARGIN = "Gross Margin Ratio %"
ASSETS, CLAIMS = "ASSETS", "LIABILITIES AND SHAREHOLDERS EQUITY"
TOTAL_CLAIMS = "TOTAL LIABILITIES AND SHAREHOLDERS EQUITY"
CAPTIONS = [("ASSETS", None), ("", None), (CLAIMS, None), ("SHAREHOLDERS EQUITY", None)]


def pl(order, balance, year=2016, company=1, label=None):
    return (0, company, year, order, label or f"P{order}", None if balance is None else D(balance))


def bs(order, balance, year=2016, company=1, label=None):
    return (1, company, year, order, label or f"B{order}", None if balance is None else D(balance))


def printed(df):
    return [(r.line_label, r.balance) for r in df.collect()]


def test_profit_and_loss_in_printing_order(spark):
    m = mart(
        spark,
        [pl(13, -1), pl(12, -2), pl(11, 4), pl(10, -8), pl(7, -32), pl(1, 64), bs(1, 1000)],
    )
    assert printed(pl_statement(m, 1, 2016)) == [
        ("  P1", D("64.00")),
        ("  P7", D("-32.00")),
        (GROSS, D("32.00")),
        ("  P10", D("-8.00")),
        ("  P11", D("4.00")),
        (BEFORE_TAXES, D("28.00")),
        ("  P12", D("-2.00")),
        ("  P13", D("-1.00")),
        (NET, D("25.00")),
        (MARGIN, D("0.50")),
    ]


def test_subtotals_exist_only_with_rows(spark):
    m = mart(spark, [pl(12, -2), pl(10, -8, year=2017), pl(3, 0, year=2018)])
    assert {(r.year, r.line_label) for r in pl_subtotals(m).collect()} == {
        (2016, NET),
        (2017, BEFORE_TAXES),
        (2017, NET),
        (2018, GROSS),
        (2018, BEFORE_TAXES),
        (2018, NET),
    }


def test_net_profit_takes_every_order(spark):
    m = mart(spark, [pl(1, 10), pl(14, None), pl(0, None), pl(20, 5), pl(21, 1, label="X")])
    assert printed(pl_statement(m, 1, 2016)) == [
        ("  P1", D("10.00")),
        (GROSS, D("10.00")),
        (BEFORE_TAXES, D("10.00")),
        (NET, D("16.00")),
    ]
    only_null = mart(spark, [pl(14, None)])
    assert printed(pl_statement(only_null, 1, 2016)) == [(NET, None)]


def test_repeated_section_prints_twice(spark):
    m = mart(spark, [pl(4, 7), pl(4, 9), bs(4, 7), bs(4, 9)])
    assert printed(pl_statement(m, 1, 2016))[:3] == [
        ("  P4", D("7.00")),
        ("  P4", D("9.00")),
        (GROSS, D("16.00")),
    ]
    lines = [line for line in printed(balance_sheet(m, 1, 2016)) if line[0] == "  B4"]
    assert lines == [("  B4", D("-9.00")), ("  B4", D("-7.00"))]


def test_margin_needs_both_sides_and_a_period(spark):
    m = mart(
        spark,
        [
            pl(1, 300),
            pl(7, -100),
            pl(1, 5, year=2017),
            pl(7, -5, year=2018),
            pl(1, 0, year=2019),
            pl(7, -5, year=2019),
            pl(1, 5, year=None),
            pl(7, -5, year=None),
            pl(1, 5, company=None),
            pl(7, -5, company=None),
        ],
    )
    got = {r.year: r.gross_margin_ratio for r in gross_margin_ratio(m).collect()}
    assert got == {2016: D("0.333333"), 2019: None}
    assert (MARGIN, None) in printed(pl_statement(m, 1, 2019))
    assert (MARGIN, D("0.33")) in printed(pl_statement(m))


def test_balance_sheet_layout_and_signs(spark):
    m = mart(spark, [bs(1, 100), bs(3, 20), bs(4, -70), bs(6, -10), bs(7, -40), pl(1, 5)])
    assert printed(balance_sheet(m, 1, 2016)) == [
        (ASSETS, None),
        ("  B1", D("100.00")),
        ("  B3", D("20.00")),
        ("TOTAL ASSETS", D("120.00")),
        ("", None),
        (CLAIMS, None),
        ("  B4", D("70.00")),
        ("  B6", D("10.00")),
        ("TOTAL LIABILITIES", D("80.00")),
        ("SHAREHOLDERS EQUITY", None),
        ("  B7", D("40.00")),
        (TOTAL_CLAIMS, D("120.00")),
    ]
    assert printed(balance_sheet_formatted(m, 1, 2016))[:3] == [
        (ASSETS, ""),
        ("  B1", "100.00"),
        ("  B3", "20.00"),
    ]


def test_captions_print_without_data_and_once(spark):
    m = mart(spark, [bs(1, 100)])
    assert printed(balance_sheet(m, 1, 1999)) == CAPTIONS
    assert printed(balance_sheet(m, 2, 2016)) == CAPTIONS
    sheet = [line for line in printed(balance_sheet(m, 1, 2016)) if line[1] is None]
    assert sheet == CAPTIONS
    assert [line for line in printed(balance_sheet(m)) if line[1] is None] == CAPTIONS


def test_year_zero_does_not_leak(spark):
    m = mart(spark, [bs(1, 100), bs(1, 55, year=0), bs(1, 55, year=0, company=-1000)])
    assert [b for _, b in printed(balance_sheet(m, 1, 2016)) if b] == [D("100.00"), D("100.00")]


def test_balance_sheet_totals(spark):
    m = mart(spark, [bs(2, 5), bs(7, -4), bs(9, 1), bs(6, -3, year=2017)])
    got = {(r.year, str(r.line_order)): r.balance for r in bs_totals(m).collect()}
    assert got == {
        (2016, "3.60"): D("5.00"),
        (2016, "7.50"): D("4.00"),
        (2017, "6.50"): D("3.00"),
        (2017, "7.50"): D("3.00"),
    }


def test_all_periods_equal_the_single_reports(spark):
    rows = [f(o, o * 10, year=y, company=c) for f in (pl, bs) for o in (1, 4, 7, 11)
            for y in (2015, 2016) for c in (1, 2)]
    m = mart(spark, rows + [pl(1, 3, year=None), bs(1, 3, year=None), bs(1, 3, company=None)])
    for report in (pl_statement, balance_sheet):
        every = report(m).collect()
        singles = [r for c in (1, 2) for y in (2015, 2016) for r in report(m, c, y).collect()]
        assert every == singles
        assert report(m, company_id=2).collect() == [r for r in every if r.company_id == 2]
        assert report(m, year=2015).collect() == [r for r in every if r.year == 2015]


def test_formatted_profit_and_loss(spark):
    m = mart(spark, [pl(1, "1234567.5"), pl(7, "-1000"), pl(2, "0")])
    assert printed(pl_statement_formatted(m, 1, 2016)) == [
        ("  P1", "1,234,567.50"),
        ("  P2", "0.00"),
        ("  P7", "-1,000.00"),
        (GROSS, "1,233,567.50"),
        (BEFORE_TAXES, "1,233,567.50"),
        (NET, "1,233,567.50"),
        (MARGIN, "0.00"),
    ]


def verdicts(spark, assets, claims):
    m = mart(spark, [bs(1, assets), bs(4, claims)])
    exact, prefix = balance_check(m).first(), balance_check_prefix(m).first()
    return exact.balance_check, prefix.balance_check_prefix


def test_identity_check(spark):
    same, different = "A = L + E", "A != L + E"
    assert verdicts(spark, "1234567.00", "-1999999.00") == (different, same)
    assert verdicts(spark, "999.40", "-999.00") == (same, same)
    assert verdicts(spark, "999.40", "-998.00") == (different, different)
    assert verdicts(spark, "123456.00", "-123000.00") == (different, same)
    assert verdicts(spark, "-5000.00", "5000.00") == (same, same)
    assert verdicts(spark, "20000000.01", "-20000000.49") == (same, same)
    assert verdicts(spark, None, "-1.00") == (None, None)


def test_identity_check_needs_both_sides_and_a_period(spark):
    m = mart(
        spark,
        [
            bs(1, 5),
            bs(7, -5, year=2017),
            bs(1, 5, year=None),
            bs(4, -5, year=None),
            bs(1, 5, year=2018),
            bs(2, 6, year=2018),
            bs(5, -10, year=2018),
            bs(9, -7, year=2018),
            pl(1, 5, year=2017),
        ],
    )
    assert [tuple(r) for r in balance_check(m).collect()] == [
        (1, 2018, D("11.00"), D("10.00"), "A != L + E")
    ]
