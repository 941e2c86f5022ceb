"""Names for columns an operator adds to a table of any columns."""

from __future__ import annotations

from collections.abc import Iterable


def unused(taken: Iterable[str], *names: str) -> list[str]:
    """Each of ``names`` with as many underscores before it as make it differ from ``taken`` and from the others."""
    seen, out = {name.lower() for name in taken}, []
    for name in names:
        while name.lower() in seen:
            name = f"_{name}"
        seen.add(name.lower())
        out.append(name)
    return out


def quoted(name: str) -> str:
    """A column's name as an expression, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"
