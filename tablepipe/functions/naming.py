"""Column-name rules (T1) and target-table names (K6): driver-side metadata."""

from __future__ import annotations

import re
from pathlib import PurePath

RENAME_RULES = ("lower", "upper", "capitalize")


def renamed(name: str, rule: str) -> str:
    """Apply a naming rule to one column name.

    ``capitalize`` is Python's ``str.capitalize``: first character upper, the
    rest lower ("FULL Name" -> "Full name"), which is not SQL ``initcap``.
    """
    rule = (rule or "lower").lower()
    if rule == "lower":
        return name.lower()
    if rule == "upper":
        return name.upper()
    if rule == "capitalize":
        return name.capitalize()
    raise ValueError(f"unknown naming rule {rule!r}; allowed: {RENAME_RULES}")


def rename_map(columns: list[str], rule: str) -> dict[str, str]:
    """Old -> new names; refuses names that collide after the rule (or before)."""
    folded: dict[str, str] = {}
    for c in columns:
        key = c.lower()
        if key in folded:
            raise ValueError(f"columns {folded[key]!r} and {c!r} differ only in case")
        folded[key] = c
    mapping = {c: renamed(c, rule) for c in columns}
    seen: dict[str, str] = {}
    for old, new in mapping.items():
        if new in seen:
            raise ValueError(f"columns {seen[new]!r} and {old!r} both become {new!r}")
        seen[new] = old
    return mapping


def target_name(name: str | None, source_path: str | None = None) -> str:
    """Normalise a target table name.

    lower case, strip, '-' -> '_', spaces removed, leading digits removed.  An
    empty result falls back to the source file stem under the same rule, then
    to ``new_table``.
    """

    def norm(v: str) -> str:
        v = v.lower().strip().replace("-", "_").replace(" ", "")
        return re.sub(r"^\d+", "", v)

    out = norm(name or "")
    if not out and source_path:
        out = norm(PurePath(source_path.rstrip("/")).stem)
    return out or "new_table"
