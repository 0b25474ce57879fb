"""Timestamps: parsing text and taking calendar parts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the text form of trip times.
TRIP_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
_TRIP_TIME_SHAPE = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"


def parse_timestamp(df: DataFrame, col: str, fmt: str | None = TRIP_TIME_FORMAT, output: str | None = None) -> DataFrame:
    """Parse a text column to a wall-clock timestamp (no time zone); text that does not fit gives null.

    ``fmt=None`` takes every form that a cast takes. The usual trip format is read as a wall-clock time directly, so hours
    that a time zone skips in spring stay as written; other formats go through the session time zone.
    """
    text = F.col(col)
    if fmt is None:
        parsed = text.try_cast("timestamp_ntz")
    elif fmt == TRIP_TIME_FORMAT:
        parsed = F.when(text.rlike(_TRIP_TIME_SHAPE), text.try_cast("timestamp_ntz"))
    else:
        parsed = F.try_to_timestamp(text, F.lit(fmt)).cast("timestamp_ntz")
    return df.withColumn(output or col, parsed)


def calendar_parts(df: DataFrame, ts_col: str, prefix: str) -> DataFrame:
    """Add ``<prefix>_year … <prefix>_sec`` as whole numbers."""
    ts = F.col(ts_col)
    return df.withColumns(
        {
            f"{prefix}_year": F.year(ts),
            f"{prefix}_month": F.month(ts),
            f"{prefix}_day": F.day(ts),
            f"{prefix}_hour": F.hour(ts),
            f"{prefix}_min": F.minute(ts),
            f"{prefix}_sec": F.second(ts).cast("int"),
        }
    )
