"""Names of helper columns that no column of a table has."""

from __future__ import annotations

from collections.abc import Iterable


def unused(columns: Iterable[str], name: str) -> str:
    """``name``, with underscores put before it as long as one of ``columns`` has it, in either case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
