"""Names for columns that exist only inside an operator."""

from __future__ import annotations

from collections.abc import Iterable


def unused(columns: Iterable[str], *names: str) -> list[str]:
    """`names`, each with as many underscores put before it as it takes to differ from every column, whatever the case."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out
