"""Flags, categories, label transforms and feature vectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def flag_encode(df: DataFrame, col: str, true_value: str = "Y") -> DataFrame:
    """Replace a flag by 1 where it equals ``true_value``, else by 0; null counts as 0."""
    return df.withColumn(col, F.when(F.col(col) == true_value, 1).otherwise(0))


def nominal(column: Column, name: str, values: Sequence) -> Column:
    """Mark a 0-based category index as categorical, so that library trees split it by subsets."""
    attribute = {"type": "nominal", "name": name, "vals": [str(v) for v in values]}
    return column.alias(name, metadata={"ml_attr": attribute})


def category_index(df: DataFrame, col: str, codes: Sequence, output: str | None = None) -> DataFrame:
    """Map the k-th of ``codes`` to k − 1 as a double marked as categorical; other values give null."""
    name = output or col
    index = None
    for position, code in enumerate(codes):
        hit = F.col(col) == F.lit(code)
        index = F.when(hit, float(position)) if index is None else index.when(hit, float(position))
    return df.withColumn(name, nominal(index, name, codes))


def log_label(y: Column | str) -> Column:
    """log(y + 1); its inverse is ``unlog_label``."""
    return F.log1p(y)


def unlog_label(p: Column | str) -> Column:
    """exp(p) − 1, back to the original unit."""
    return F.expm1(p)


def to_double(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Cast columns to double; text that is no number gives null."""
    return df.withColumns({c: F.col(c).try_cast("double") for c in cols})


def assemble(
    df: DataFrame, cols: Sequence[str], output: str = "features", as_array: bool = False, handle_invalid: str = "error"
) -> DataFrame:
    """Pack columns into one ML vector, or into ``array<double>`` with ``as_array``.

    ``handle_invalid`` says what a null does in both forms: ``error`` raises, ``skip`` drops the row, ``keep`` keeps it
    (as NaN in a vector, as null in an array).
    """
    cols = list(cols)
    if not as_array:
        return VectorAssembler(inputCols=cols, outputCol=output, handleInvalid=handle_invalid).transform(df)
    if handle_invalid == "skip":
        df = df.dropna(how="any", subset=cols)
    values = [F.col(c).cast("double") for c in cols]
    if handle_invalid == "error":
        values = [
            F.when(F.col(c).isNotNull(), v).otherwise(F.raise_error(F.lit(f"null in feature {c}")).cast("double"))
            for c, v in zip(cols, values)
        ]
    elif handle_invalid not in ("skip", "keep"):
        raise ValueError(f"handle_invalid must be error, skip or keep, not {handle_invalid!r}")
    return df.withColumn(output, F.array(*values))


def feature_columns(df: DataFrame, label: str, drop: Sequence[str] = ()) -> list[str]:
    """All column names but the label and ``drop``."""
    return [c for c in df.columns if c != label and c not in drop]
