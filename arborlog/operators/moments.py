"""Column statistics and z-scores."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborlog.functions.text import literal, number, quoted


def moments(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``feature, n, mean, std`` with the population std, in one pass.

    A constant column gets std 1.0 and an empty one (0.0, 1.0), so that a z-score can always divide.
    """
    aggregates, rows = [], []
    for i, c in enumerate(cols):
        x = quoted(c)
        aggregates += [f"count({x}) AS n{i}", f"CAST(avg({x}) AS DOUBLE) AS mean{i}", f"stddev_pop({x}) AS std{i}"]
        rows.append(
            f"named_struct('feature', {literal(c)}, 'n', n{i}, 'mean', coalesce(mean{i}, 0.0D),"
            f" 'std', CASE WHEN std{i} > 0 THEN std{i} ELSE 1.0D END)"
        )
    return df.selectExpr(*aggregates).selectExpr(f"inline(array({', '.join(rows)}))")


def moments_map(table: DataFrame) -> dict[str, tuple[float, float]]:
    """The moments table as ``{feature: (mean, std)}``: one small row per feature."""
    return {r["feature"]: (r["mean"], r["std"]) for r in table.collect()}


def zscore(df: DataFrame, cols: Sequence[str], stats: DataFrame | Mapping[str, tuple[float, float]]) -> DataFrame:
    """Replace each column by (x − mean) / std with statistics that were computed before, on the training part."""
    known = moments_map(stats) if isinstance(stats, DataFrame) else stats
    return df.withColumns(
        {c: F.expr(f"({quoted(c)} - {number(known[c][0])}) / {number(known[c][1])}") for c in cols}
    )
