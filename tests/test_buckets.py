"""A bucketed journal with an entry that has a third of all lines."""

from datetime import date
from decimal import Decimal as D
from statistics import median

import duckdb
import pytest

import oracles
from tallybook.operators import build_section_balance, posted_lines
from tallybook.sources import ledger_from_buckets, ledger_from_orders, merge_ledgers, save_bucketed_journal
from tests.compare import assert_same
from tests.ledgers import Book
from tests.test_random_ledgers import random_book

BUCKETS = 8


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def database(spark, tmp_path):
    spark.sql(f"CREATE DATABASE books LOCATION '{tmp_path}/books'")
    yield "books"
    spark.sql("DROP DATABASE books CASCADE")


def bucketed(spark, database, ledger):
    save_bucketed_journal(ledger, f"{database}.entry", f"{database}.line", BUCKETS)
    return ledger_from_buckets(spark, ledger, f"{database}.entry", f"{database}.line")


def hot_book() -> Book:
    """6,000 of 18,000 lines, all alike, are those of entry 7."""
    lines = [(7, 1, D("1.00"), None)] * 6000
    lines += [(100 + i % 4000, 1, D(i) / 100, None) for i in range(12_000)]
    entries = [(7, date(2016, 1, 1), 0)] + [(100 + i, date(2015 + i % 3, 1, 1), i % 50 == 0) for i in range(4000)]
    entries = [(i, d, int(c)) for i, d, c in entries]
    return Book([(1, 101, 151)], [(101, 0, 1, 1, "REVENUE"), (151, 1, 1, 1, "CASH")], entries, lines)


def test_no_shuffle_and_no_large_task(spark, database):
    ledger = hot_book().ledger(spark)
    stored = bucketed(spark, database, ledger)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = posted_lines(stored)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan
        sizes = [r["count"] for r in joined.selectExpr("spark_partition_id() AS p").groupBy("p").count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(sizes) == BUCKETS and max(sizes) <= 3 * median(sizes)
    assert rows(build_section_balance(stored)) == rows(build_section_balance(ledger))


@pytest.mark.parametrize("seed", [11])
def test_random_ledgers_give_the_same_balances(spark, database, seed):
    ledger = random_book(seed).ledger(spark)
    stored = bucketed(spark, database, ledger)
    assert rows(build_section_balance(stored)) == rows(build_section_balance(ledger))
    assert rows(build_section_balance(stored, years=[1996], company_id=1)) == rows(
        build_section_balance(ledger, years=[1996], company_id=1)
    )


def test_lines_that_are_expanded_after_the_join(spark, database):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for table in ("orders", "lineitem", "supplier"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    stored = bucketed(spark, database, ledger_from_orders(spark, sf))
    assert assert_same(build_section_balance(stored), con, oracles.on_given_tables()["section_balance"])


def test_nothing_to_store_and_what_is_refused(spark, database):
    empty = Book().ledger(spark)
    stored = bucketed(spark, database, empty)
    assert rows(build_section_balance(stored)) == []
    with pytest.raises(ValueError):
        merge_ledgers({0: stored})
    with pytest.raises(ValueError):
        save_bucketed_journal(empty, "books.e", "books.l", 0)
