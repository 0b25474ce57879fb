"""Scores of linear models as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from arborlog.functions.text import number

# Terms of one group of a written-out sum.
GROUP = 64


def dot(features: Sequence[str], weights: Sequence[float]) -> Column:
    """Sum of feature · weight over column names or expression texts, written out as one generated expression.

    Terms are added in groups, so that the expression of a wide row is no deeper than a group and the number of groups.
    """
    terms = [f"{x} * {number(w)}" for x, w in zip(features, weights, strict=True)]
    groups = [" + ".join(["0.0D", *terms[i : i + GROUP]]) for i in range(0, max(1, len(terms)), GROUP)]
    return F.expr(groups[0] if len(groups) == 1 else " + ".join(f"({g})" for g in groups))


def dot_arrays(a: Column, b: Column) -> Column:
    """Dot product of two array columns of any width."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, t: acc + t)


def add_arrays(a: Column, b: Column) -> Column:
    """Element-wise sum of two array columns."""
    return F.zip_with(a, b, lambda x, y: x + y)


def scale_array(a: Column, factor) -> Column:
    """Every element times ``factor``."""
    return F.transform(a, lambda x: x * factor)


def sigmoid(z: Column) -> Column:
    """1 / (1 + exp(−z)). A far negative z makes exp infinite and the quotient 0, so no guard is needed."""
    return 1.0 / (1.0 + F.exp(-z))


def hard_label(probability: Column, threshold: float = 0.5) -> Column:
    """1.0 from the threshold on, else 0.0; null stays null, as an unknown chance is no decision."""
    return F.when(probability >= threshold, 1.0).when(probability.isNotNull(), 0.0)
