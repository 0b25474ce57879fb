"""Row filters and null checks."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborlog.functions.text import literal, quoted


class Range(NamedTuple):
    """Allowed values of a column. ``closed`` names the ends that belong to it: both, neither, left or right."""

    column: str
    low: float
    high: float
    closed: str = "both"


def range_filter(df: DataFrame, rules: Iterable[Range | tuple]) -> DataFrame:
    """Keep rows that meet every rule; a null fails."""
    for rule in rules:
        column, low, high, closed = Range(*rule)
        if closed not in ("both", "neither", "left", "right"):
            raise ValueError(f"closed must be both, neither, left or right, not {closed!r}")
        c = F.col(column)
        df = df.filter(c >= low if closed in ("both", "left") else c > low)
        df = df.filter(c <= high if closed in ("both", "right") else c < high)
    return df


def null_profile(df: DataFrame) -> DataFrame:
    """``column, null_count`` for every column, in one pass."""
    counts = [f"count_if({quoted(c)} IS NULL) AS n{i}" for i, c in enumerate(df.columns)]
    rows = [f"named_struct('column', {literal(c)}, 'null_count', n{i})" for i, c in enumerate(df.columns)]
    return df.selectExpr(*counts).selectExpr(f"inline(array({', '.join(rows)}))")


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null in any column (of ``subset``).

    Written as one test per column, which a columnar scan can take over; columns that cannot be null need none.
    """
    fields = {f.name: f for f in df.schema.fields}
    for c in subset or df.columns:
        if fields[c].nullable:
            df = df.filter(F.col(quoted(c)).isNotNull())
    return df
