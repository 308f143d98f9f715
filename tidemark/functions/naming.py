"""Column naming conventions, applied to the name list at plan time."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence


def snake_case(name: str) -> str:
    """`SystemCalendarID` becomes `system_calendar_id`."""
    spaced = re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1_\2", name)
    spaced = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", spaced)
    return re.sub(r"_+", "_", sql_safe(spaced)).lower()


def sql_safe(name: str) -> str:
    safe = re.sub(r"[^0-9A-Za-z_]", "_", name)
    return f"_{safe}" if safe[:1].isdigit() else safe


def keep(name: str) -> str:
    return name


def sql_safe_lower(name: str) -> str:
    return sql_safe(name).lower()


# The five conventions.
CONVENTIONS: dict[str, Callable[[str], str]] = {
    "snake_case": snake_case,
    "duck_case": keep,
    "direct": keep,
    "sql_cs_v1": sql_safe,
    "sql_ci_v1": sql_safe_lower,
}


def convert_names(names: Sequence[str], convention: str) -> list[str]:
    """New names in order; two names that meet are an error naming both."""
    if convention not in CONVENTIONS:
        raise ValueError(f"unknown naming convention {convention!r}")
    return unique_names(names, [CONVENTIONS[convention](name) for name in names])


def unique_names(old: Sequence[str], new: Sequence[str]) -> list[str]:
    seen: dict[str, str] = {}
    for before, after in zip(old, new):
        clash = seen.setdefault(after.lower(), before)
        if clash is not before:
            raise ValueError(f"columns {clash!r} and {before!r} would both be named {after!r}")
    return list(new)
