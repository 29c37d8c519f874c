"""The section-balance table on disk, partitioned by year, and the digests kept with it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession, functions as F

from tallybook.schema import DIGEST, SECTION_BALANCE, conform, ddl


def _writer(df: DataFrame) -> DataFrameWriter:
    """The rebalance keeps one year in as few files as its size allows and splits a year
    that is much larger than the others."""
    out = conform(df, SECTION_BALANCE).hint("rebalance", F.col("year"))
    # The whole table, whatever the session says about partitions.
    return out.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("year")


def write_section_balance(df: DataFrame, path: str) -> None:
    """Replace the table at ``path``.

    Entries without a date land in the default partition and read back with a NULL year.
    """
    _writer(df).parquet(path)


def save_section_balance(df: DataFrame, table: str) -> None:
    """Replace the catalog table ``table``; read it with ``spark.table``."""
    _writer(df).saveAsTable(table, format="parquet")


def read_section_balance(spark: SparkSession, path: str) -> DataFrame:
    """Read the table; a filter on year prunes partitions."""
    return spark.read.schema(ddl(SECTION_BALANCE)).parquet(path).select(*SECTION_BALANCE)


def restate_section_balance(
    spark: SparkSession, fresh: DataFrame, years: Sequence[int], old_path: str, new_path: str
) -> None:
    """Write to ``new_path`` the table at ``old_path`` with ``years`` taken from ``fresh``.

    ``fresh`` comes from ``build_section_balance(ledger, years=years)``, which reads only
    those years of the journal. Writing beside the old table keeps it readable until the
    caller switches, and a year that has become empty really disappears, which a dynamic
    partition overwrite would leave in place.
    """
    if old_path.rstrip("/") == new_path.rstrip("/"):
        raise ValueError("new_path must differ from old_path")
    restated = F.col("year").isin(list(years))
    kept = read_section_balance(spark, old_path).where(~F.coalesce(restated, F.lit(False)))
    fresh = conform(fresh, SECTION_BALANCE).where(restated)
    write_section_balance(kept.unionByName(fresh), new_path)


def write_digest(digest: DataFrame, path: str) -> None:
    """Replace the digest at ``path``, a folder beside that of the section balances."""
    conform(digest, DIGEST).write.mode("overwrite").parquet(path)


def read_digest(spark: SparkSession, path: str) -> DataFrame:
    """A digest as ``write_digest`` left it, to ``reconcile`` with a new one."""
    return spark.read.schema(ddl(DIGEST)).parquet(path)
