"""Pieces of SQL expression text."""

from __future__ import annotations


def quoted(text: str) -> str:
    """A string literal."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def row(**fields: str) -> str:
    """A struct with the given field expressions."""
    return "named_struct(" + ", ".join(f"'{n}', {value}" for n, value in fields.items()) + ")"
