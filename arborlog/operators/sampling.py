"""Repeatable random splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_PARTS = 1 << 32


def split_draw(keys: Sequence[str], seed: int = 24) -> Column:
    """A number of 32 bits that depends on the seed and the key values only."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def in_part(keys: Sequence[str], fraction: float = 0.8, seed: int = 24) -> Column:
    """Whether a row falls into the first part."""
    return split_draw(keys, seed) < round(fraction * _PARTS)


def hash_split(
    df: DataFrame, keys: Sequence[str] | str, fraction: float = 0.8, seed: int = 24
) -> tuple[DataFrame, DataFrame]:
    """Split into (train, test) by a hash of the keys.

    The same row falls on the same side however the table is partitioned or re-read, and nothing is shuffled. Rows with
    equal keys stay together, so the keys should identify a row.
    """
    in_train = in_part([keys] if isinstance(keys, str) else list(keys), fraction, seed)
    return df.filter(in_train), df.filter(~in_train)
