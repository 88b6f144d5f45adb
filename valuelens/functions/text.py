"""Pieces of SQL text."""

from __future__ import annotations

from collections.abc import Iterable, Mapping


def quoted(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def one_of(column: str, values: Iterable[str]) -> str:
    """Membership in a list, which may be empty."""
    options = ", ".join(quoted(value) for value in values)
    return f"{column} in ({options})" if options else "false"


def case_of(column: str, results: Mapping[str, str]) -> str:
    """A CASE from values to SQL results; NULL for all other values."""
    branches = " ".join(f"when {quoted(value)} then {sql}" for value, sql in results.items())
    return f"case {column} {branches} end"


def struct_array(fields: list[str], rows: Iterable[Iterable[str]]) -> str:
    """An array of structs from SQL values, to inline."""
    structs = (
        "struct(" + ", ".join(f"{sql} as {name}" for name, sql in zip(fields, row)) + ")"
        for row in rows
    )
    return f"array({', '.join(structs)})"
