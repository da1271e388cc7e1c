"""Column-name cleaning for raw CSV headers (Bronze contract)."""

from __future__ import annotations

# A header containing any of these characters is rewritten ...
MARKED_CHARACTERS = " ()%[].,;:{}"
# ... with these replacements, in this order.  The other marked characters
# ([ ] , ; : { }) are detected but kept as they are.
REPLACEMENTS = (("(", "_"), (")", "_"), ("%", "pct"), (".", "_"), (" ", "_"))


def clean_column_name(name: str) -> str:
    """``Temperature(F)`` -> ``Temperature_F_``, ``Humidity(%)`` -> ``Humidity_pct_``."""
    if not any(ch in MARKED_CHARACTERS for ch in name):
        return name
    for old, new in REPLACEMENTS:
        name = name.replace(old, new)
    return name


def present(columns, wanted):
    """Keep the wanted names that exist (column-presence guard)."""
    have = set(columns)
    return [c for c in wanted if c in have]
