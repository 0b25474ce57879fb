"""Pieces of SQL expression text.

Wide rows are written as one expression text instead of hundreds of column objects: the plan is the same, but the driver makes
one call to the JVM instead of one per term.
"""

from __future__ import annotations

import math


def quoted(name: str) -> str:
    """A column name as an identifier."""
    return "`" + name.replace("`", "``") + "`"


def literal(text: str) -> str:
    """A string constant."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def number(value: float) -> str:
    """A double constant."""
    value = float(value)
    return f"{value!r}D" if math.isfinite(value) else f"CAST('{value!r}' AS DOUBLE)"
