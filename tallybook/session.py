"""Sessions: one for a single machine, and the settings a cluster job should carry."""

from __future__ import annotations

import math

from pyspark.sql import SparkSession

MEGABYTE = 1024 * 1024
#: Above this, the blocks that scan tasks write for each partition are too many to merge.
MOST_PARTITIONS = 300_000


def cluster_settings(journal_bytes: int) -> dict[str, str]:
    """Settings for a journal whose used columns take about ``journal_bytes`` on disk.

    The large join shuffles about as much. Its partition count has to fit before the shuffle
    is written: adaptive execution merges small partitions afterwards, but of large ones it
    splits only the skewed. A partition has 128 MB up to 40 TB of journal; above, there are
    300,000, of 330 MB at 100 TB. So many need a shuffle service that merges blocks: submit the job with
    ``spark.shuffle.push.enabled``, which a running session cannot change. Without one, keep
    the journal bucketed by entry, which joins without a shuffle. Scan tasks grow with the journal from 128 MB to 1 GB.

    The hash-join threshold lets adaptive execution replace the sort-merge join, so that
    the lines need no sort, once every partition of the entries is known to fit a hash
    table: up to 300,000 partitions of 64 MB, or 19 TB of entries. It has to be at least the
    advisory partition size to take effect.

    Sums need ANSI mode, and dates of timestamps must not depend on where a job runs.
    """
    partitions = min(max(math.ceil(journal_bytes / (128 * MEGABYTE)), 200), MOST_PARTITIONS)
    scan_bytes = min(max(math.ceil(journal_bytes / 50_000), 128 * MEGABYTE), 1024 * MEGABYTE)
    return {
        "spark.sql.files.maxPartitionBytes": str(scan_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(64 * MEGABYTE),
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": str(64 * MEGABYTE),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.ansi.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }


def local_session(cores: int | str = "*", memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tallybook")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
