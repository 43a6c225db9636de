"""Names for working columns that no table can already hold."""

from __future__ import annotations

from collections.abc import Iterable


def free_name(wish: str, *taken: Iterable[str]) -> str:
    """``wish`` between underscores, with as many as it takes to differ, in any case, from every name in ``taken``."""
    used = {name.lower() for names in taken for name in names}
    name = f"_{wish}_"
    while name.lower() in used:
        name = f"_{name}_"
    return name
