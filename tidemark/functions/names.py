"""Names for helper columns that no user column has."""

from __future__ import annotations

from collections.abc import Iterable


def free_names(taken: Iterable[str], *wanted: str) -> list[str]:
    """``wanted`` with underscores appended until they clash with nothing, upper and lower case alike."""
    used = {name.lower() for name in taken}
    found = []
    for name in wanted:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        found.append(name)
    return found
