"""What must hold in the derived ledger, and a chart of lines of one's own."""

from decimal import Decimal as D

import pytest

from tallybook.chart import Chart, Ratio, Statement, Total
from tallybook.operators import balance_check, build_section_balance, gross_margin_ratio
from tallybook.plans import balance_sheet, pl_statement, pl_year_over_year
from tallybook.sources import ledger_from_orders
from tests.ledgers import book
from tests.test_section_balance import DAY

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def derived(spark):
    df = build_section_balance(ledger_from_orders(spark, SF_DIR)).cache()
    yield df
    df.unpersist()


def statements(df):
    found = {}
    for r in df.collect():
        lines = found.setdefault((r.company_id, r.year), {})
        lines[str(r.line_order)] = r.balance
    return found


def test_profit_and_loss_adds_up(derived):
    found = statements(pl_statement(derived))
    assert len(found) == 350
    for lines in found.values():
        amount = {k: v or D(0) for k, v in lines.items()}.get
        detail = [amount(f"{o}.00", D(0)) for o in range(1, 14)]
        assert amount("9.50") == sum(detail[:9])
        assert amount("11.50") == amount("9.50") + sum(detail[9:11])
        assert amount("13.50") == amount("11.50") + sum(detail[11:])


def test_balance_sheet_adds_up(derived):
    found = statements(balance_sheet(derived))
    assert len(found) == 350
    for lines in found.values():
        assert lines["3.60"] == sum(lines.get(f"{o}.00", 0) for o in (1, 2, 3))
        assert lines.get("6.50", 0) == sum(lines.get(f"{o}.00", 0) for o in (4, 5, 6))
        assert lines["7.50"] == lines.get("6.50", 0) + lines.get("7.00", 0)


def test_only_the_company_with_missing_credits_is_out_of_balance(derived):
    for r in balance_check(derived).collect():
        assert r.balance_check == ("A != L + E" if r.company_id == 5 else "A = L + E")


def test_special_lines_of_the_derived_ledger(derived):
    assert derived.count() > 5000
    silent = derived.where("company_id = 1 AND statement_section_order = 11")
    assert {r.balance for r in silent.collect()} == {D(0)}
    nothing = derived.where(
        "company_id = 2 AND is_balance_sheet_section = 0 AND statement_section_order = 12"
    )
    assert nothing.count() == 0


def test_another_chart_of_lines(spark):
    chart = Chart(
        income=(10,),
        expense=(20, 30),
        assets=(1,),
        liabilities_and_equity=(2,),
        profit_loss=Statement(
            is_balance_sheet=False,
            plain=(10,),
            negated=(20, 30),
            totals=(Total("35", "Owner's result", None, sign=-1),),
            captions=(),
        ),
        balance_sheet=Statement(True, (1,), (2,), (Total("1.5", "SUM", (1,)),), (("0", "TOP"),)),
        margin=Ratio("99", "Cost share", numerator=20, denominator=10),
    )
    sections = [(i, 0, 1, order, f"S{order}") for i, order in enumerate((10, 20, 30), start=1)]
    sections += [(4, 1, 1, 1, "HAVE"), (5, 1, 1, 2, "OWE")]
    accounts = [(i, i if i < 4 else 0, i if i > 3 else 0) for i in range(1, 6)]
    postings = [(DAY, 1, D(8), None), (DAY, 2, D(2), None), (DAY, 3, D(1), None)]
    postings += [(DAY, 4, D(5), None), (DAY, 5, None, D(5))]
    ledger = book(sections, accounts, postings).ledger(spark)
    m = build_section_balance(ledger, chart)

    def printed(df):
        return [(r.line_label, r.balance) for r in df.collect()]

    assert printed(pl_statement(m, 1, 2016, chart)) == [
        ("  S10", D(8)),
        ("  S20", D(2)),
        ("  S30", D(1)),
        ("Owner's result", D(-5)),
        ("Cost share", D("0.25")),
    ]
    assert printed(balance_sheet(m, chart=chart)) == [
        ("TOP", None),
        ("  HAVE", D(5)),
        ("SUM", D(5)),
        ("  OWE", D(5)),
    ]
    assert gross_margin_ratio(m, chart).first().gross_margin_ratio == D("0.25")
    report = pl_year_over_year(m, ledger.section, 1, [2016], chart).collect()
    assert [(r.line_label, r.b2016) for r in report][-1] == ("Owner's result", D(-5))
    assert balance_check(m, chart).first().balance_check == "A = L + E"
