"""Column names that cannot clash with those of a caller's table."""

from __future__ import annotations


def fresh(columns: list[str], name: str) -> str:
    """``name``, with as many underscores before it as it takes to be in none of ``columns``."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
