"""Running sums in value order that no single task has to sort.

1. Aggregate the source once to one row per (group, value) and keep that table in the shared folder; a hot value becomes one row
   on the map side. All later steps read the kept table.
2. Give every row a range bucket: coarse bounds, and finer ones inside the coarse buckets of large tables.
3. Add up the buckets; the result is a table of at most groups × buckets rows with the running totals before each bucket.
4. Run a window inside (group, bucket) and add the total before the bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arborlog.functions.buckets import COARSE_BUCKETS, buckets_for, with_fine_buckets
from arborlog.session import reliable_checkpoint


def prefix_sums(
    df: DataFrame,
    order: str,
    sums: dict[str, Column],
    group: Sequence[str] = (),
    buckets: int | None = None,
    coarse: int = COARSE_BUCKETS,
    kept: bool = False,
) -> DataFrame:
    """Running sums of ``sums`` by ascending ``order`` inside each ``group``.

    ``sums`` maps output names to per-row columns. The result has one row per (group, order value) with the sums of that
    value, their running sums ``cum_<name>`` (this value included) and ``next_value``, the following value of the group.
    ``buckets`` defaults to a number that follows from the number of different values; with 1 each group is put in order by one task.
    ``kept`` says that ``df`` is a kept table with one row per (group, value) already, so it is neither added up nor written again.
    """
    group, names = list(group), list(sums)
    rows = df.select(*group, order, *[c.alias(s) for s, c in sums.items()])
    cells = rows if kept else rows.groupBy(*group, order).agg(*[F.sum(s).alias(s) for s in names])
    if buckets != 1:
        cells = cells if kept else reliable_checkpoint(cells)
        cells, cut = with_fine_buckets(cells, order, buckets or buckets_for(cells.count()), coarse)
    if buckets == 1 or not cut:
        in_order = Window.partitionBy(*group).orderBy(order)
        running = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return cells.select(
            *group,
            order,
            *names,
            *[F.sum(s).over(running).alias(f"cum_{s}") for s in names],
            F.lead(order).over(in_order).alias("next_value"),
        )

    by_bucket = Window.partitionBy(*group).orderBy("_bucket")
    earlier = by_bucket.rowsBetween(Window.unboundedPreceding, -1)
    totals = cells.groupBy(*group, "_bucket").agg(F.min(order).alias("_first"), *[F.sum(s).alias(s) for s in names])
    offsets = totals.select(
        *[F.col(g).alias(f"_{g}") for g in group],
        F.col("_bucket").alias("_at"),
        F.lead("_first").over(by_bucket).alias("_next_first"),
        *[F.coalesce(F.sum(s).over(earlier), F.lit(0)).alias(f"_before_{s}") for s in names],
    )
    same = F.col("_bucket") == F.col("_at")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_{g}"))
    in_order = Window.partitionBy(*group, "_bucket").orderBy(order)
    running = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return cells.join(offsets, same).select(
        *group,
        order,
        *names,
        *[(F.sum(s).over(running) + F.col(f"_before_{s}")).alias(f"cum_{s}") for s in names],
        F.coalesce(F.lead(order).over(in_order), F.col("_next_first")).alias("next_value"),
    )


def tie_ranks(
    df: DataFrame, score: str, group: Sequence[str] = (), sums: dict[str, Column] | None = None, buckets: int | None = None
) -> DataFrame:
    """Average rank of each score value: ``score, n, avg_rank`` with ranks from 1 by ascending score.

    Rows with equal scores share the mean of their first and last rank. Extra ``sums`` are added up per score value.
    """
    extra = sums or {}
    ranked = prefix_sums(df, score, {"n": F.lit(1), **extra}, group, buckets)
    avg_rank = F.col("cum_n") - (F.col("n") - 1) / 2
    return ranked.select(*group, score, "n", *extra, avg_rank.alias("avg_rank"))
