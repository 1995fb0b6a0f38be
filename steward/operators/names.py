"""Names for helper columns."""

from __future__ import annotations

from collections.abc import Iterable


def unused(columns: Iterable[str], *wanted: str) -> list[str]:
    """For each wanted name one that no column has, whatever its case: the name itself, or with underscores added."""
    taken, out = {c.lower() for c in columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
