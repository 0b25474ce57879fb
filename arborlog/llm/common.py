"""What several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arborlog.session import written  # noqa: F401

# ASCII white space, as the word patterns of this subpackage use it: space and the five controls 09 to 0D.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def columns(names: Iterable[str]) -> list[Column]:
    """Columns by their whole names, which may hold dots and back quotes."""
    return [F.col("`" + name.replace("`", "``") + "`") for name in names]


def held_out(doc_id: str = "doc_id") -> Column:
    """The rows that no model of this subpackage learns from: crc32 of the id as text leaves 2 when divided by 4.

    A null id counts as the empty text.
    """
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 4 == 2
