"""Range buckets with explicit bounds.

The bounds are fixed numbers in the plan. A lost executor therefore recomputes a row into the bucket it had before, which
``repartitionByRange`` (it samples anew) does not promise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arborlog.session import broadcast_if_small, reliable_checkpoint

# Even a small table gets a few buckets, so that every size takes the same way.
MIN_BUCKETS, MAX_BUCKETS = 8, 65_536
ROWS_PER_BUCKET = 50_000
BOUND_ROWS_PER_BUCKET = 500
# Bounds that are constants of a plan; more buckets are cut inside these.
COARSE_BUCKETS = 4096


def buckets_for(rows: int) -> int:
    """Buckets for a table of this size: one per 50,000 rows, 8 at least."""
    return max(MIN_BUCKETS, rows // ROWS_PER_BUCKET)


def bucket_count(rows: int) -> int:
    """The same where all bounds are constants of a plan: beyond 3.3 billion rows the buckets grow instead of their number."""
    return min(MAX_BUCKETS, buckets_for(rows))


def _constant_array(numbers: Sequence[float]) -> Column:
    # One string literal that folds to one array literal; thousands of separate literals would slow the planner.
    return F.split(F.lit(",".join(repr(n) for n in numbers)), ",").cast("array<double>")


def quantile_bounds(df: DataFrame, cols: Sequence[str], buckets: int, rows: int | None = None) -> list[list[float]]:
    """For each column, at most ``buckets`` − 1 ascending distinct bounds at approximate quantiles.

    One pass for all columns: the sketches merge on the map side and one row of bounds reaches the driver. A value that
    fills several quantiles gives one bound. The bounds only decide how even the buckets are, never a result; with the row
    count of a large table given, they come from some 500 rows per bucket (as a range partitioner takes them), so that the
    sketches of many thousand tasks stay tiny where they meet.
    """
    if buckets < 2:
        return [[] for _ in cols]
    if rows and rows > 2 * BOUND_ROWS_PER_BUCKET * buckets:
        df = df.sample(BOUND_ROWS_PER_BUCKET * buckets / rows, seed=24)
    steps = _constant_array([i / buckets for i in range(1, buckets)])
    sketches = []
    for i, c in enumerate(cols):
        value = F.col(c).cast("double")
        sketches.append(F.percentile_approx(F.when(~F.isnan(value), value), steps, max(1000, 4 * buckets)).alias(f"q{i}"))
    row = df.agg(*sketches).first()
    return [sorted(set(q or ())) for q in row]


def with_fine_buckets(df: DataFrame, order: str, buckets: int, coarse: int = COARSE_BUCKETS) -> tuple[DataFrame, bool]:
    """``df`` with ``_bucket``, about ``buckets`` range buckets of ``order`` in ascending order, and whether there are any bounds.

    Up to ``coarse`` bounds are constants of the plan. More buckets than that are cut inside the coarse ones: each coarse bucket gets
    its own bounds, a row of a table that is kept in the shared folder, so the driver holds ``coarse`` numbers at most whatever the
    size. ``df`` is read several times and should be a kept table.
    """
    count = df.count() if buckets > 1 else None
    (bounds,) = quantile_bounds(df, [order], min(buckets, coarse), count)
    if not bounds:
        return df.withColumn("_bucket", F.lit(0).cast("bigint")), False
    rows = with_buckets(df, {order: "_coarse"}, [bounds])
    parts = -(-buckets // coarse)
    if parts == 1:
        return rows.withColumn("_bucket", F.col("_coarse").cast("bigint")).drop("_coarse"), True
    value = F.col(order).cast("double")
    steps = _constant_array([i / parts for i in range(1, parts)])
    inner = F.array_distinct(F.percentile_approx(F.when(~F.isnan(value), value), steps, max(1000, 4 * parts)))
    some = rows.sample(BOUND_ROWS_PER_BUCKET * buckets / count, seed=24) if count > 2 * BOUND_ROWS_PER_BUCKET * buckets else rows
    fine = reliable_checkpoint(some.groupBy("_coarse").agg(inner.alias("_fine")))
    # A coarse bucket without bounds (nulls or NaN alone, which are one value, or no sampled row) stays whole.
    rows = rows.join(broadcast_if_small(fine, coarse * parts), "_coarse", "left")
    below = F.size(F.filter(F.coalesce("_fine", F.array().cast("array<double>")), lambda b: b <= value))
    return rows.withColumn("_bucket", F.col("_coarse") * F.lit(parts).cast("bigint") + below).drop("_coarse", "_fine"), True


def with_buckets(df: DataFrame, columns: dict[str, str], bounds: Sequence[Sequence[float]]) -> DataFrame:
    """Add a bucket number for each column (``columns`` maps input to output names): its bounds at or below the value.

    Null lies in bucket 0 and NaN in the last one, which is their sort order.
    """
    inputs, outputs = list(columns), list(columns.values())
    cut = [i for i, b in enumerate(bounds) if b]
    ends = float("inf")
    if cut:
        # ``_v`` columns: the bucketizer wants doubles, and null must not land in its bucket for invalid values.
        df = df.withColumns({f"_v{i}": F.coalesce(F.col(inputs[i]).cast("double"), F.lit(-ends)) for i in cut})
        df = Bucketizer(
            splitsArray=[[-ends, *bounds[i], ends] for i in cut],
            inputCols=[f"_v{i}" for i in cut],
            outputCols=[outputs[i] for i in cut],
            handleInvalid="keep",
        ).transform(df)
        df = df.drop(*[f"_v{i}" for i in cut])
    # Never null, so that a join on the bucket adds no null test to the scan.
    return df.withColumns(
        {o: F.coalesce(F.col(o).cast("int"), F.lit(0)) if i in cut else F.lit(0) for i, o in enumerate(outputs)}
    )
