"""Published versions of the section balances: readers never see half of a change.

A folder holds files and manifests. A writer adds files under a name of its own, then a manifest
under the next number, which one rename makes visible; that is the only moment of change. A
manifest names the files of every year, so a restatement writes the years that it restates and
keeps the files of the others. A reader takes one manifest and reads what it names, to the end,
whatever is published meanwhile. Files are never changed, and go only by ``forget_versions``.

The rename must be atomic and refuse an existing target, as on HDFS and local disks.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallybook.schema import SECTION_BALANCE, conform, ddl

_MANIFESTS, _DATA = "_versions", "data"
_NO_YEAR = "__HIVE_DEFAULT_PARTITION__"


class VersionConflict(RuntimeError):
    """Another writer has published the version that this one was about to publish."""


@dataclass(frozen=True)
class Version:
    """number: from 1. folders: of each year, as text, below the table's data; one per year."""

    number: int
    folders: dict[str, str]


class _Files:
    """The file system of a path, as Spark's driver sees it."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._jvm, self._gateway = spark._jvm, spark.sparkContext._gateway
        self._conf = spark._jsc.hadoopConfiguration()
        self.fs = self.path(path).getFileSystem(self._conf)

    def path(self, text: str):
        return self._jvm.org.apache.hadoop.fs.Path(text)

    def names(self, folder: str) -> list[str]:
        found = self.path(folder)
        if not self.fs.exists(found):
            return []
        return [status.getPath().getName() for status in self.fs.listStatus(found)]

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        stream = self.fs.create(self.path(name), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def rename(self, old: str, new: str) -> None:
        """Raises where ``new`` exists; FileSystem.rename would replace it on some systems."""
        kind = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self._gateway.new_array(kind, 1)
        options[0] = kind.NONE
        target = self.fs.makeQualified(self.path(new))
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            target.toUri(), self._conf
        )
        context.rename(self.fs.makeQualified(self.path(old)), target, options)

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


def _manifest(path: str, number: int) -> str:
    return f"{path}/{_MANIFESTS}/{number:012d}.json"


def version_numbers(spark: SparkSession, path: str) -> list[int]:
    """The versions that can be read, the current one last."""
    names = _Files(spark, path).names(f"{path}/{_MANIFESTS}")
    return sorted(int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit())


def find_version(spark: SparkSession, path: str, number: int | None = None) -> Version | None:
    """A version, the current one by default; None if nothing is published yet."""
    known = version_numbers(spark, path)
    if number is None and not known:
        return None
    if number is not None and number not in known:
        raise ValueError(f"no version {number} in {path}; there are {known}")
    number = known[-1] if number is None else number
    found = json.loads(_Files(spark, path).read(_manifest(path, number)))
    return Version(number, found["folders"])


def read_version(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The section balances of a version, the current one by default.

    The version is fixed here: later publications do not reach the DataFrame. A filter on year
    prunes folders.
    """
    version = find_version(spark, path, number)
    if version is None:
        raise ValueError(f"nothing is published in {path}")
    schema = ddl(SECTION_BALANCE)
    if not version.folders:
        return spark.createDataFrame([], schema)
    folders = [f"{path}/{_DATA}/{folder}" for folder in version.folders.values()]
    reader = spark.read.schema(f"{schema}, load string").option("basePath", f"{path}/{_DATA}")
    return reader.parquet(*folders).select(*SECTION_BALANCE)


def publish(
    df: DataFrame,
    path: str,
    years: Sequence[int | None] | None = None,
    based_on: int | None = None,
) -> int:
    """Publish section balances as the next version, and return its number.

    With ``years``, ``df`` restates those years, None being the entries without a date, and all
    others stay as they are in the version before, whose files are shared. A year that ``df`` has
    no rows for is empty from now on. Without ``years``, ``df`` is the whole table.

    ``based_on`` is the version that ``df`` was derived from, the current one by default (0 if
    there is none). If another writer was faster, VersionConflict is raised and nothing changes;
    the same holds for a failure at any earlier point. What was written then lies unused until
    ``forget_versions``.
    """
    spark = df.sparkSession
    files = _Files(spark, path)
    known = version_numbers(spark, path)
    current = known[-1] if known else 0
    based_on = current if based_on is None else based_on
    if based_on != current:
        raise VersionConflict(f"{path} is at version {current}, not {based_on}")
    folders = find_version(spark, path, current).folders if current else {}
    out = conform(df, SECTION_BALANCE)
    if years is None:
        folders = {}
    else:
        named = [year for year in years if year is not None]
        restated = F.col("year").isin(named)
        if None in years:
            restated |= F.col("year").isNull()
        out = out.where(restated)
        gone = {_NO_YEAR if year is None else str(year) for year in years}
        folders = {year: folder for year, folder in folders.items() if year not in gone}
    load = f"load={uuid.uuid4().hex}"
    # The rebalance keeps a year in as few files as its size allows.
    out.hint("rebalance", F.col("year")).write.partitionBy("year").parquet(f"{path}/{_DATA}/{load}")
    for name in files.names(f"{path}/{_DATA}/{load}"):
        if name.startswith("year="):
            folders[name.removeprefix("year=")] = f"{load}/{name}"
    _switch(files, path, Version(based_on + 1, folders))
    return based_on + 1


def _switch(files: _Files, path: str, version: Version) -> None:
    """Make a version the current one: a manifest appears whole, under a number of its own."""
    draft = f"{path}/{_MANIFESTS}/.draft-{uuid.uuid4().hex}"
    files.write(draft, json.dumps({"folders": version.folders}, sort_keys=True))
    try:
        files.rename(draft, _manifest(path, version.number))
    except Py4JJavaError as error:
        files.delete(draft)
        if "FileAlreadyExists" not in str(error.java_exception):
            raise
        raise VersionConflict(f"version {version.number} of {path} exists") from error


def forget_versions(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Delete all but the last versions and the files that no version left names; how many loads.

    Readers of a version that goes lose its files, and a writer that has not switched yet loses
    what it wrote: call it when neither is at work.
    """
    if keep < 1:
        raise ValueError("the current version stays")
    files = _Files(spark, path)
    numbers = version_numbers(spark, path)
    kept = [find_version(spark, path, number) for number in numbers[-keep:]]
    for number in numbers[:-keep]:
        files.delete(_manifest(path, number))
    for name in files.names(f"{path}/{_MANIFESTS}"):
        if name.startswith(".draft-"):
            files.delete(f"{path}/{_MANIFESTS}/{name}")
    used = {folder for version in kept for folder in version.folders.values()}
    loads = {folder.partition("/")[0] for folder in used}
    gone = 0
    for load in files.names(f"{path}/{_DATA}"):
        if load not in loads:
            files.delete(f"{path}/{_DATA}/{load}")
            gone += 1
            continue
        for name in files.names(f"{path}/{_DATA}/{load}"):
            if name.startswith("year=") and f"{load}/{name}" not in used:
                files.delete(f"{path}/{_DATA}/{load}/{name}")
    return gone
