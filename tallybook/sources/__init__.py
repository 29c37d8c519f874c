"""Ledger inputs and the section-balance table."""

from tallybook.sources.buckets import ledger_from_buckets, save_bucketed_journal
from tallybook.sources.clustered import ledger_from_clustered, save_clustered_journal
from tallybook.sources.ledger import (
    Ledger,
    ledger_from_files,
    ledger_from_reader,
    ledger_from_tables,
    merge_ledgers,
)
from tallybook.sources.mart import (
    read_digest,
    read_section_balance,
    restate_section_balance,
    save_section_balance,
    write_digest,
    write_section_balance,
)
from tallybook.sources.orders import ledger_from_orders
from tallybook.sources.versions import (
    VersionConflict,
    forget_versions,
    publish,
    read_version,
    version_numbers,
)

__all__ = [
    "Ledger",
    "VersionConflict",
    "forget_versions",
    "ledger_from_buckets",
    "ledger_from_clustered",
    "ledger_from_files",
    "ledger_from_orders",
    "ledger_from_reader",
    "ledger_from_tables",
    "merge_ledgers",
    "publish",
    "read_digest",
    "read_section_balance",
    "read_version",
    "restate_section_balance",
    "save_bucketed_journal",
    "save_clustered_journal",
    "save_section_balance",
    "version_numbers",
    "write_digest",
    "write_section_balance",
]
