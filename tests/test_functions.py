"""The shared expressions."""

from decimal import Decimal as D

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tallybook.functions import (
    change_ratio,
    change_ratio_column,
    exact_sum,
    format_money,
    format_money_column,
    indent,
    quoted,
)
from tests.ledgers import frame

AMOUNTS = {"k": "int", "amount": "decimal(18,2)"}
MOST = D("9999999999999999.99")


def value(spark, text):
    return spark.sql(f"SELECT {text} AS v").first().v


@settings(max_examples=8, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.integers(0, 2),
            st.none() | st.decimals(min_value=-MOST, max_value=MOST, places=2),
        ),
        max_size=40,
    )
)
def test_exact_sum(spark, rows):
    df = frame(spark, AMOUNTS, rows).groupBy("k")
    got = {r.k: r.s for r in df.agg(F.expr(exact_sum("amount")).alias("s")).collect()}
    expected = {}
    for k, amount in rows:
        expected.setdefault(k, None)
        if amount is not None:
            expected[k] = (expected[k] or D(0)) + amount
    assert got == expected


def test_exact_sum_of_extremes(spark):
    df = spark.range(10_000_000).selectExpr(f"CAST({MOST} AS decimal(18,2)) AS amount")
    assert df.agg(F.expr(exact_sum("amount"))).first()[0] == 10_000_000 * MOST
    assert df.agg(F.expr(exact_sum("-amount"))).first()[0] == -10_000_000 * MOST


@pytest.mark.parametrize(
    "current, previous, expected",
    [
        ("50.00BD", "100.00BD", -0.5),
        ("50.00BD", "0.00BD", 0.0),
        ("50.00BD", "CAST(NULL AS decimal(28,2))", 0.0),
        ("CAST(NULL AS decimal(28,2))", "50.00BD", 0.0),
        ("-150.00BD", "-100.00BD", 0.5),
        ("110.00BD", "100.00BD", 0.1),
    ],
)
def test_change_ratio(spark, current, previous, expected):
    assert value(spark, change_ratio(current, previous)) == pytest.approx(expected)


def test_change_ratio_can_tell_missing_from_unchanged(spark):
    assert value(spark, change_ratio("5.00BD", "0.00BD", "NULL")) is None
    assert value(spark, change_ratio("5.00BD", "5.00BD", "NULL")) == 0.0


@pytest.mark.parametrize(
    "amount, digits, expected",
    [
        ("0.125BD", 2, "0.13"),
        ("2.5BD", 0, "3"),
        ("-2.5BD", 0, "-3"),
        ("1234567.891BD", 2, "1,234,567.89"),
        ("-0.001BD", 2, "0.00"),
        ("99999999999999999999999999.99BD", 2, "99,999,999,999,999,999,999,999,999.99"),
        ("CAST(NULL AS decimal(28,2))", 2, None),
    ],
)
def test_format_money(spark, amount, digits, expected):
    assert value(spark, format_money(amount, digits)) == expected


def test_labels(spark):
    assert value(spark, indent("'CASH'")) == "  CASH"
    assert value(spark, indent("CAST(NULL AS string)")) is None
    for text in ("it's", "back\\slash", 'double "quote"', ""):
        assert value(spark, quoted(text)) == text


def test_column_forms(spark):
    df = spark.sql("SELECT 110.00BD AS a, 100.00BD AS b, 0.00BD AS z")
    ratios = df.select(
        change_ratio_column(F.col("a"), F.col("b")),
        change_ratio_column("a", "z"),
        change_ratio_column("a", "z", missing=None),
        format_money_column("a"),
        format_money_column(F.col("a") * 1000, 0),
    ).first()
    assert tuple(ratios) == (pytest.approx(0.1), 0.0, None, "110.00", "110,000")


def test_text_forms_refuse_columns(spark):
    for call in (lambda c: change_ratio(c, "b"), lambda c: change_ratio("a", c), format_money):
        with pytest.raises(TypeError):
            call(F.lit(1))
