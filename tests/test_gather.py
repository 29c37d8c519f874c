"""Joined lines brought together before they are summed: where accounts are many, and one is hot."""

import re
from dataclasses import replace
from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tallybook import operators as ops
from tallybook.sources import ledger_from_orders
from tests.ledgers import Book
from tests.test_plans import settings

SUPPLIERS, ORDERS, PARTITIONS = 60, 3000, 8
#: As if the tables were large: shuffles of several partitions, and no broadcast.
LARGE = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": str(PARTITIONS),
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}
GATHERED = [
    *("bs_section_balance", "section_balance", "pl_subtotals", "bs_totals", "gross_margin_ratio"),
    *("pl_statement_all", "balance_sheet_all", "balance_check", "balance_check_prefix"),
    *("all_reports", "journal_reconciled", "section_balance_stored", "section_balance_bucketed"),
]


def save_orders(spark, path, supplier: str) -> str:
    """Orders of seven years, each with five lines whose supplier is the SQL text ``supplier``."""
    orders = spark.range(ORDERS).selectExpr(
        "id AS o_orderkey",
        "CAST(make_date(1992 + CAST(id % 7 AS INT), 3, 1) AS timestamp_ntz) AS o_orderdate",
        "IF(id % 5 = 0, '5-LOW', '1-URGENT') AS o_orderpriority",
    )
    lines = spark.range(5 * ORDERS).selectExpr(
        "id DIV 5 AS l_orderkey",
        "pmod(xxhash64(id, 1), 1000) AS l_partkey",
        f"{supplier} AS l_suppkey",
        "CAST(1 + id % 5 AS INT) AS l_linenumber",
        "CAST(pmod(xxhash64(id, 3), 100000) AS DOUBLE) / 100 AS l_extendedprice",
    )
    suppliers = spark.range(SUPPLIERS).withColumnRenamed("id", "s_suppkey")
    for name, df in (("orders", orders), ("lineitem", lines), ("supplier", suppliers)):
        df.coalesce(2).write.parquet(f"{path}/{name}.parquet")
    return str(path)


@pytest.fixture
def many(spark, tmp_path):
    return save_orders(spark, tmp_path / "many", f"pmod(xxhash64(id, 2), {SUPPLIERS})")


@pytest.fixture
def hot(spark, tmp_path):
    """Half of the lines are those of supplier 7, a tenth has none."""
    rest = f"IF(id % 10 = 1, NULL, pmod(xxhash64(id, 2), {SUPPLIERS}))"
    return save_orders(spark, tmp_path / "hot", f"IF(id % 2 = 0, 7L, {rest})")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_tasks_hold_the_sums_of_few_accounts(spark, many):
    """An account is summed in one task or two, not in each."""
    with settings(spark, LARGE):
        posted = ops.posted_lines(contract._ledger(spark, many))
        groups = posted.selectExpr("spark_partition_id() AS task", "account_id", "year").distinct()
        held, all_of = groups.count(), posted.select("account_id", "year").distinct().count()
    assert all_of > 3000 and held <= 2 * all_of


@pytest.mark.parametrize("key", GATHERED)
def test_queries_gather_their_lines(spark, many, key, monkeypatch):
    """The sum of every registered query stands on gathered lines."""
    seen = []
    joined_lines = ops.balances.joined_lines

    def spied(*args):
        seen.append(joined_lines(*args))
        return seen[-1]

    monkeypatch.setattr(ops.balances, "joined_lines", spied)
    monkeypatch.setattr(ops.digest, "joined_lines", spied)
    contract.ledger_queries()[key](spark, many)
    assert seen
    for lines in seen:
        plan = lines._jdf.queryExecution().optimizedPlan().toString()
        assert plan.startswith("RebalancePartitions [l_suppkey")


def test_lines_of_one_company_stay_where_they_are(spark, many):
    posted = ops.posted_lines(contract._ledger(spark, many), company_id=3)
    assert "Rebalance" not in posted._jdf.queryExecution().optimizedPlan().toString()


def test_a_hot_supplier_has_several_tasks(spark, hot):
    small = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB"}
    with settings(spark, LARGE | small):
        lines = ops.balances.joined_lines(contract._ledger(spark, hot))
        rest = "sum(l_partkey + l_linenumber + l_extendedprice + journal_entry_id) AS rest"
        by_task = lines.groupBy(F.spark_partition_id()).agg(
            F.expr("count_if(l_suppkey = 7) AS n"), F.expr(rest)
        )
        sizes = [r.n for r in by_task.collect() if r.n]
    assert len(sizes) > 2 and max(sizes) < sum(sizes) / 2


@pytest.mark.parametrize("table", ["many", "hot"])
def test_gathered_or_not_the_results_are_the_same(spark, table, request):
    path = request.getfixturevalue(table)
    plain = ledger_from_orders(spark, path)
    ledger = replace(plain, gather="l_suppkey")
    with settings(spark, LARGE):
        for result in (ops.build_section_balance, ops.journal_digest, ops.kept_totals, ops.bs_section_balance):
            assert rows(result(ledger)) == rows(result(plain))
        some = {"years": [1993, 1995]}
        assert rows(ops.build_section_balance(ledger, **some)) == rows(ops.build_section_balance(plain, **some))


BY_CHART = [key for key in GATHERED if key not in ("journal_reconciled", "section_balance_stored")]


@pytest.mark.parametrize("key", BY_CHART)
def test_accounts_and_sections_are_not_broadcast(spark, many, key):
    """Spark takes them for as small as the list of suppliers that they are derived from."""
    plan = contract.ledger_queries()[key](spark, many)._jdf.queryExecution().executedPlan().toString()
    for name in ("account_id", "statement_section_id"):
        assert re.search(rf"SortMergeJoin \[{name}#", plan)
        assert not re.search(rf"BroadcastHashJoin \[{name}#", plan)


@pytest.mark.parametrize("result", [ops.pl_section_balance, ops.journal_digest])
def test_other_sums_do_not_broadcast_them_either(spark, many, result):
    plan = result(contract._ledger(spark, many))._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"SortMergeJoin \[(?:account_id|statement_section_id)#", plan)) == 2
    assert not re.search(r"BroadcastHashJoin \[(?:account_id|statement_section_id)#", plan)


def test_maintained_balances_do_not_broadcast_them(spark, many):
    ledger = contract._ledger(spark, many)
    balances = ops.maintained_balances(ops.kept_totals(ledger), ledger)
    plan = balances._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"BroadcastHashJoin \[(?:account_id|statement_section_id)#", plan)


HASHED = [key for key in BY_CHART if key != "section_balance_bucketed"]


@pytest.mark.parametrize("key", HASHED)
def test_lines_are_not_sorted_for_their_entries(spark, many, key):
    """The sort of the lines is what a task of the large join held; entries are hashed instead."""
    with settings(spark, LARGE):
        plan = contract.ledger_queries()[key](spark, many)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"ShuffledHashJoin \[journal_entry_id#\d+L\], .*BuildRight", plan)
    assert not re.search(r"(SortMergeJoin|BroadcastHashJoin) \[journal_entry_id#", plan)


def test_lines_of_a_hot_entry_are_dealt_to_several_tasks(spark, hot):
    """A third of the lines are those of one entry; the tasks that share them hash that one each."""
    ledger = contract._ledger(spark, hot)
    third = ledger.line.withColumn("journal_entry_id", F.expr("IF(l_partkey % 3 = 0, 7L, journal_entry_id)"))
    small = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
    }
    hashed = replace(ledger, line=third)
    with settings(spark, LARGE | small):
        balances = ops.build_section_balance(hashed)
        got = rows(balances)
        plan = balances._jdf.queryExecution().executedPlan().toString()
        assert got == rows(ops.build_section_balance(replace(hashed, gather=None))) != []
    assert "ShuffledHashJoin(skew=true) [journal_entry_id#" in plan


def test_entries_that_are_there_twice_or_have_no_id_count_as_before(spark):
    day = date(2016, 5, 1)
    entry = [(1, day, 0), (1, day, 0), (1, date(2017, 5, 1), 0), (2, day, 1), (2, day, 0), (None, day, 0), (3, None, 0)]
    line = [(e, a, D(f"{e or 9}.01"), D(a)) for e in (None, 1, 1, 2, 3, 4) for a in (1, 2)]
    account, section = [(1, 10, 20), (2, 10, 20)], [(10, 0, 1, 1, "A"), (20, 1, 1, 4, "B")]
    plain = Book(account, section, entry, line).ledger(spark)
    ledger = replace(plain, gather="account_id")
    for result in (ops.build_section_balance, ops.pl_section_balance, ops.bs_section_balance, ops.journal_digest):
        assert rows(result(ledger)) == rows(result(plain)) != []


def test_lines_of_one_company_meet_entries_as_spark_picks(spark, many):
    posted = ops.posted_lines(contract._ledger(spark, many), company_id=3)
    assert "ShuffledHashJoin" not in posted._jdf.queryExecution().executedPlan().toString()


def test_odd_accounts_and_sections_count_as_before(spark):
    """Accounts and sections that are there twice, link nowhere or to 0, or have no id or order."""
    account = [(1, 10, 20), (1, 10, 20), (2, 0, 0), (3, None, 20), (4, 10, None)]
    account += [(None, 10, 20), (5, 99, 99), (6, 20, 10), (7, 30, 30)]
    section = [(10, 0, 1, 1, "A"), (10, 0, 2, 1, "A"), (20, 1, 1, 4, "B"), (20, 1, 1, 4, "B"), (0, 0, 0, 0, "NONE")]
    section += [(None, 0, 1, 7, "C"), (30, 1, 1, None, "D")]
    day = date(2016, 5, 1)
    entry = [(1, day, 0), (2, day, 1), (3, None, 0), (4, date(2017, 1, 1), 0)]
    line = [(e, a, D(f"{10 * e}.01"), None if a == 3 else D(a)) for e in (1, 2, 3, 4) for a in (1, 2, 3, 4, 5, 6, 7)]
    line += [(1, None, D(1), None), (1, 1, None, None)]
    plain = Book(account, section, entry, line).ledger(spark)
    ledger = replace(plain, gather="account_id")
    for result in (ops.build_section_balance, ops.pl_section_balance, ops.bs_section_balance, ops.journal_digest):
        assert rows(result(ledger)) == rows(result(plain)) != []
