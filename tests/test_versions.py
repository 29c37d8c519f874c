"""Published versions: pinned readers, shared files, crashes and rival writers."""

import os
from decimal import Decimal as D

import pytest

from tallybook.sources import (
    VersionConflict,
    forget_versions,
    publish,
    read_version,
    version_numbers,
    versions,
)
from tests.ledgers import mart


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def balances(spark, **by_year):
    return mart(spark, [
        (0, 1, None if y == "none" else int(y[1:]), 1, "REVENUE", D(a)) for y, a in by_year.items()
    ])


def amounts(df):
    return {r["year"]: int(r["balance"]) for r in df.collect()}


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "published")


def test_a_reader_keeps_its_version(spark, path):
    assert publish(balances(spark, y2015=1, y2016=2, none=3), path) == 1
    pinned = read_version(spark, path)
    assert publish(balances(spark, y2016=20, y2017=30), path, years=[2016, 2017]) == 2
    fresh = read_version(spark, path)
    assert publish(balances(spark, none=7), path, years=[None, 2015]) == 3
    assert amounts(pinned) == {2015: 1, 2016: 2, None: 3}
    assert amounts(fresh) == {2015: 1, 2016: 20, 2017: 30, None: 3}
    # 2015 has no rows any more.
    assert amounts(read_version(spark, path)) == {2016: 20, 2017: 30, None: 7}
    assert amounts(read_version(spark, path, 2)) == amounts(fresh)
    assert version_numbers(spark, path) == [1, 2, 3]
    assert publish(balances(spark, y2020=1), path) == 4
    assert amounts(read_version(spark, path)) == {2020: 1}


def test_types_and_odd_rows_come_back(spark, path):
    m = mart(spark, [(0, 1, 2016, 1, "A=B/ c", D("9.99")), (1, None, None, 1, None, None),
                     (1, 2, -5, 1, "", D("99999999999999999999999999.99"))])
    publish(m, path)
    stored = read_version(spark, path)
    assert stored.schema.simpleString() == m.schema.simpleString() and rows(stored) == rows(m)
    publish(m.limit(0), path)
    assert rows(read_version(spark, path)) == []
    publish(m, path, years=[2016])
    assert len(rows(read_version(spark, path))) == 1


def test_rows_of_other_years_are_not_published(spark, path):
    publish(balances(spark, y2015=1), path)
    publish(balances(spark, y2015=9, y2016=9), path, years=[2016])
    assert amounts(read_version(spark, path)) == {2015: 1, 2016: 9}


def test_untouched_years_share_their_files(spark, path):
    publish(balances(spark, y2015=1, y2016=2), path)
    first = {f for f in read_version(spark, path).inputFiles() if "year=2015" in f}
    publish(balances(spark, y2016=3), path, years=[2016])
    second = read_version(spark, path)
    assert first == {f for f in second.inputFiles() if "year=2015" in f} and len(first) == 1
    filtered = second.where("year = 2016")
    plan = filtered._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


@pytest.mark.parametrize("stage", ["write", "rename"])
def test_a_crash_before_the_switch_changes_nothing(spark, path, monkeypatch, stage):
    publish(balances(spark, y2015=1), path)
    pinned = read_version(spark, path)

    def crash(*_):
        raise OSError("gone")

    with monkeypatch.context() as patched:
        patched.setattr(versions._Files, stage, crash)
        with pytest.raises(OSError):
            publish(balances(spark, y2015=2), path, years=[2015])
    assert version_numbers(spark, path) == [1]
    assert amounts(read_version(spark, path)) == amounts(pinned) == {2015: 1}
    assert publish(balances(spark, y2015=3), path, years=[2015]) == 2
    assert amounts(read_version(spark, path)) == {2015: 3}
    loads = os.listdir(f"{path}/data")
    assert len([name for name in loads if name.startswith("load=")]) == 3
    assert forget_versions(spark, path) == 2
    assert amounts(read_version(spark, path)) == {2015: 3} and version_numbers(spark, path) == [2]


def test_only_one_of_two_writers_wins(spark, path, monkeypatch):
    publish(balances(spark, y2015=1), path)
    with pytest.raises(VersionConflict):
        publish(balances(spark, y2015=2), path, based_on=0)
    # The other one publishes while this one writes its files.
    real = versions._switch

    def late(files, where, version):
        monkeypatch.setattr(versions, "_switch", real)
        publish(balances(spark, y2016=5), path, years=[2016])
        real(files, where, version)

    monkeypatch.setattr(versions, "_switch", late)
    with pytest.raises(VersionConflict):
        publish(balances(spark, y2015=9), path, years=[2015])
    assert amounts(read_version(spark, path)) == {2015: 1, 2016: 5}
    assert version_numbers(spark, path) == [1, 2]


def test_forgetting_keeps_what_the_last_versions_name(spark, path):
    for i in range(4):
        publish(balances(spark, **{f"y{2015 + i}": i, "y2030": i}), path, years=[2015 + i, 2030])
    assert forget_versions(spark, path, keep=2) == 0
    assert version_numbers(spark, path) == [3, 4]
    assert amounts(read_version(spark, path)) == {2015: 0, 2016: 1, 2017: 2, 2018: 3, 2030: 3}
    assert amounts(read_version(spark, path, 3)) == {2015: 0, 2016: 1, 2017: 2, 2030: 2}
    with pytest.raises(ValueError, match="no version 1"):
        read_version(spark, path, 1)
    with pytest.raises(ValueError):
        forget_versions(spark, path, keep=0)


def test_nothing_is_published_yet(spark, path):
    with pytest.raises(ValueError, match="nothing is published"):
        read_version(spark, path)
    assert version_numbers(spark, path) == []
