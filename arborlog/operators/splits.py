"""Exact best splits of regression-tree nodes, for all nodes of a level at once.

Every midpoint between neighbouring distinct values of a feature is a candidate. The gain of a split is the variance of the
node minus the weighted variance of its children, which equals (n_l · n_r / n²) · (mean_l − mean_r)². Real-valued labels are
taken relative to their mean over all rows, a node whose labels are all equal is not split, nor one whose best gain is no more
than rounding (10^-12 of its variance), and gains that agree to 12 digits are equal, whatever order they were summed up in.

Rows are first added up in range cells (node, feature, cell), which are kept: they give the statistics of every node, the gain at every
cell border, and a bound for the gain inside a cell. Between two borders, (n_l, sum_l) moves in the parallelogram that the least and the greatest label of the cell allow; the gain is convex,
so its maximum over the parallelogram is at a corner. Cells whose bound is below the best border gain of their node cannot
hold the best split. Only the rows of the other cells are looked at value by value, after cutting large cells finer. No
candidate is lost, and the shuffles carry cells instead of values.

A categorical feature has a cell per category. Ordered by their mean label, the best subset of categories is one of the first k.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arborlog.functions.buckets import bucket_count, quantile_bounds, with_buckets
from arborlog.session import MAX_BROADCAST_ROWS, reliable_checkpoint

# Cells with more rows than this are cut into equal ranges before their values are looked at; so many per cell that a round
# makes at most ROUND_CELLS of them.
CELL_ROWS = 5_000_000
MAX_SUB_CELLS = 1024
ROUND_CELLS = 4_000_000
MAX_ROUNDS = 4
# Cells of one node meet in one task, so a table with very many features gets fewer for each.
NODE_CELLS = 4_000_000
# A subset of categories is the bits of one whole number.
MAX_ARITY = 63
# Slack of the pruning test for rounding in the bound.
_SLACK = 1 - 1e-9
# Gains of at most this share of the node's variance are rounding; equal gains agree to so many digits.
_LEAST_GAIN, _DIGITS = 1e-12, 12

_CELL = ["node", "feature", "cell"]


def node_stats(df: DataFrame, label: str, node: str) -> DataFrame:
    """Label statistics of every node in one pass: ``node, n, total, mean, variance, lowest, highest``."""
    y = F.col(label)
    return (
        df.groupBy(F.col(node).alias("node"))
        .agg(
            F.count(y).alias("n"),
            F.sum(y).alias("total"),
            F.var_pop(y).alias("variance"),
            F.min(y).alias("lowest"),
            F.max(y).alias("highest"),
        )
        .select(
            "node", "n", "total", (F.col("total").cast("double") / F.nullif("n", F.lit(0))).alias("mean"),
            "variance", "lowest", "highest",
        )
    )


def split_gain(left_n: str, left_sum: str, n: str = "tn", total: str = "ts") -> Column:
    """Variance reduction of a split from count and label sum on the left and in all; null if a side is empty.

    The arguments are column names or expression texts.
    """
    ln, ls, tn, ts = (f"CAST({c} AS DOUBLE)" for c in (left_n, left_sum, n, total))
    gap = f"({ls} / nullif({ln}, 0.0D) - ({ts} - {ls}) / nullif({tn} - {ln}, 0.0D))"
    return F.expr(f"{ln} * ({tn} - {ln}) / ({tn} * {tn}) * ({gap} * {gap})")


def with_cells(rows: DataFrame, width: int, bounds: Sequence[Sequence[float]], categorical: Collection[int] = ()) -> DataFrame:
    """Add the cell numbers ``b0 …`` of the features ``x0 …``: their ranges between ``bounds``, or their category."""
    ranges = [i for i in range(width) if i not in categorical]
    rows = with_buckets(rows, {f"x{i}": f"b{i}" for i in ranges}, [bounds[i] for i in ranges])
    return rows.withColumns({f"b{i}": F.col(f"x{i}").cast("int") for i in categorical}) if categorical else rows


def cell_bounds(rows: DataFrame, width: int, buckets: int, count: int | None, categorical: Collection[int] = ()) -> list[list[float]]:
    """Bounds of the cells of the features ``x0 …``; none for a categorical one."""
    buckets = max(1, min(buckets, NODE_CELLS // max(1, width)))
    ranges = [i for i in range(width) if i not in categorical]
    found = dict(zip(ranges, quantile_bounds(rows, [f"x{i}" for i in ranges], buckets, count))) if ranges else {}
    return [found.get(i, []) for i in range(width)]


def best_splits(
    df: DataFrame, features: Sequence[str], label: str, node: str | None = None, buckets: int | None = None
) -> DataFrame:
    """``node, feature, threshold, gain``: the best split of every node that has one with a gain above 0.

    ``feature`` is the position in ``features``. Equal gains go to the first feature, then to the lowest threshold. Features
    must be free of null and NaN. ``node`` names a node-number column; without it all rows are node 1.
    """
    width = len(features)
    rows = df.select(
        (F.col(node) if node else F.lit(1)).cast("bigint").alias("node"),
        F.col(label).alias("y"),
        *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)],
    )
    count = None
    if buckets is None:
        count = rows.count()
        buckets = bucket_count(count)
    if not _whole(rows):
        rows = centered(rows, rows.agg(F.avg("y")).first()[0])
    rows = with_cells(rows, width, cell_bounds(rows, width, buckets, count))
    found = level_splits(rows, width, keep=reliable_checkpoint)
    return found.filter(F.col("feature").isNotNull()).select("node", "feature", "threshold", "gain")


def level_splits(
    rows: DataFrame,
    width: int,
    keep: Callable[[DataFrame], DataFrame],
    cell_rows: int = CELL_ROWS,
    halvings: int = 0,
    categorical: Collection[int] = (),
) -> DataFrame:
    """``node, n, total, feature, threshold, subset, gain, left_n, left_total`` of a prepared table ``node, y, x0 … b0 …``.

    One row per node: its row count and label sum, and its best split with those of the left side, or nulls. A split of a ``categorical``
    feature has no threshold but a ``subset``, the bits of the categories that go left. ``keep`` stores a small
    table of cells that is read several times (persist or checkpoint). ``halvings`` merges that many times two neighbouring cells: a
    level with many nodes has few rows per node, and the number of cells stays the same from level to level.
    """
    candidates = _candidates(rows, width, keep, cell_rows, halvings, categorical)
    gain = F.col("gain")
    if _whole(rows):  # sums of whole numbers are exact
        size = [gain.alias("size")]
    else:
        power = F.floor(F.log10("gain"))
        size = [power.alias("power"), F.round(gain * F.pow(F.lit(10.0), _DIGITS - 1 - power)).alias("size")]
    choice = F.struct("feature", "threshold", "subset", "gain", "left_n", "left_total")
    rank = F.when(gain > 0, F.struct(*size, -F.col("feature"), -F.col("place")))
    best = candidates.groupBy("node").agg(
        F.max_by(choice, rank).alias("best"),
        F.max("tn").alias("n"),
        F.max("ts").alias("total"),
        F.min("y_min").alias("lowest"),
        F.max("y_max").alias("highest"),
        F.sum("squares").alias("squares"),
    )
    mean = F.col("total").cast("double") / F.col("n")
    variance = F.greatest(F.col("squares") / F.col("n") - mean * mean, F.lit(0.0))
    splits = (F.col("lowest") < F.col("highest")) & (F.col("best.gain") > _LEAST_GAIN * variance)
    return best.withColumn("best", F.when(splits, F.col("best"))).select("node", "n", "total", "best.*")


def _whole(rows: DataFrame) -> bool:
    return isinstance(rows.schema["y"].dataType, T.IntegralType)


def centered(rows: DataFrame, mean: float | None) -> DataFrame:
    """Labels ``y`` relative to their mean, which keeps the digits of small differences between large labels."""
    return rows.withColumn("y", F.col("y").cast("double") - F.lit(float(mean or 0.0)))


def _long(rows: DataFrame, positions: Iterable[int], halvings: int, categorical: Collection[int] = ()) -> DataFrame:
    """One row per (row, feature): ``node, y, feature, value, cell``."""
    shape = "named_struct('feature', {i}, 'value', x{i}, 'cell', CAST(shiftright(b{i}, {k}) AS BIGINT))"
    parts = [shape.format(i=i, k=0 if i in categorical else halvings) for i in positions]
    return rows.select("node", "y", F.expr(f"inline(array({', '.join(parts)}))"))


def _midpoint(low: Column, high: Column) -> Column:
    middle = (low + high) / 2
    # Between two neighbouring doubles the middle rounds to one of them; the threshold must stay below the upper one.
    return F.when(middle < high, middle).otherwise(low)


def _cell_sums(long: DataFrame, *by: str, squares: bool = False) -> DataFrame:
    return long.groupBy(*_CELL, *by).agg(
        *([F.sum("yy").alias("squares")] if squares else []),
        F.count("*").alias("n"),
        F.sum("y").alias("s"),
        F.min("y").alias("y_min"),
        F.max("y").alias("y_max"),
        F.min("value").alias("low"),
        F.max("value").alias("high"),
    )


def _running(cells: DataFrame, within: Sequence[str], order: Sequence[str] = ("cell",)) -> DataFrame:
    """Running sums over the cells of ``within`` (their number is bounded by the bucket count), and the next low end."""
    in_order = Window.partitionBy(*within).orderBy(*order)
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return cells.withColumns(
        {"cum_n": F.sum("n").over(so_far), "cum_s": F.sum("s").over(so_far), "next_low": F.lead("low").over(in_order)}
    )


_SPLIT = ["node", "feature", "threshold", "subset", "place", "gain", "left_n", "left_total"]


def _threshold_splits(cells: DataFrame, high: str, low: str) -> DataFrame:
    """Splits between ``high`` and the next value ``low``, with the sums so far as their left sides."""
    middle = _midpoint(F.col(high), F.col(low))
    gain = F.when(F.col(low).isNotNull(), _gain_after())
    return cells.withColumns(
        {"threshold": middle, "subset": F.lit(None).cast("bigint"), "place": middle, "gain": gain, "left_n": F.col("cum_n"), "left_total": F.col("cum_s")}
    )


def _node_cells(long: DataFrame, categorical: Collection[int]) -> DataFrame:
    """The cells of all nodes with the split after each, the node's statistics, and whether a better split may lie inside."""
    long = long.withColumn("yy", F.when(F.col("feature") == F.lit(0), F.col("y").cast("double") * F.col("y")))
    whole = Window.partitionBy("node", "feature")
    is_category = F.col("feature").isin(*categorical) if categorical else F.lit(False)
    # Categories stand in the order of their means.
    cells = _cell_sums(long, squares=True).withColumn("rank", F.when(is_category, F.col("s").cast("double") / F.col("n")))
    cells = _running(cells, ["node", "feature"], ("rank", "cell")).withColumns({"tn": F.sum("n").over(whole), "ts": F.sum("s").over(whole)})
    cells = _threshold_splits(cells, "high", "next_low")
    if categorical:
        so_far = Window.partitionBy("node", "feature").orderBy("rank", "cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        bits = F.sum(F.expr("shiftleft(1L, CAST(cell AS INT))")).over(so_far)
        cells = cells.withColumns(
            {
                "subset": F.when(is_category, bits),
                "place": F.when(is_category, F.row_number().over(Window.partitionBy("node", "feature").orderBy("rank", "cell")).cast("double")).otherwise(F.col("place")),
                "threshold": F.when(~is_category, F.col("threshold")),
            }
        )
    best = F.coalesce(F.max("gain").over(Window.partitionBy("node")), F.lit(0.0))
    return cells.withColumn("open", (F.col("low") < F.col("high")) & (_inner_bound() >= best * _SLACK))


def _gain_after() -> Column:
    return split_gain("cum_n", "cum_s")


def _inner_bound() -> Column:
    """Upper bound for the gain of any split inside a cell: the best corner of the parallelogram."""
    # Rows with the greatest label if the cell held only its two extreme labels; they come first or last.
    top = "((s - CAST(n AS DOUBLE) * y_min) / nullif(CAST(y_max AS DOUBLE) - y_min, 0.0D))"
    corners = [
        (f"(cum_n - n + {top})", f"(cum_s - s + {top} * y_max)"),
        (f"(cum_n - {top})", f"(cum_s - s + (n - {top}) * y_min)"),
        ("(cum_n - n)", "(cum_s - s)"),
        ("cum_n", "cum_s"),
    ]
    return F.greatest(*[F.coalesce(split_gain(cn, cs), F.lit(0.0)) for cn, cs in corners])


def _candidates(
    rows: DataFrame, width: int, keep: Callable[[DataFrame], DataFrame], cell_rows: int, halvings: int, categorical: Collection[int]
) -> DataFrame:
    """All splits that may be the best of their node: ``_SPLIT`` and, in one row per cell, what makes up the node's statistics."""
    stats = ["tn", "ts", "y_min", "y_max", "squares"]
    cells = keep(_node_cells(_long(rows, range(width), halvings, categorical), categorical))
    found = cells.select(*_SPLIT, *stats)
    still_open = cells.filter("open")
    long, edges = None, None

    for round_ in range(MAX_ROUNDS):
        size = still_open.agg(
            F.count("*").alias("cells"),
            F.coalesce(F.max("n"), F.lit(0)).alias("rows"),
            F.sort_array(F.collect_set("feature")).alias("features"),
        ).first()
        if not size["cells"]:
            return found
        if round_ == 0:
            # Features without an open cell are out from here on.
            long = _long(rows, size["features"], halvings, categorical)
        edges = still_open.select(
            *_CELL, "low", "high", "tn", "ts",
            (F.col("cum_n") - F.col("n")).alias("before_n"), (F.col("cum_s") - F.col("s")).alias("before_s"),
        )
        if size["cells"] > MAX_BROADCAST_ROWS:
            # Too many cells to send everywhere: the values are aggregated first and then meet their cell in a shuffle.
            break
        long = long.join(F.broadcast(edges), _CELL)
        edges = None
        if size["rows"] <= cell_rows or round_ == MAX_ROUNDS - 1:
            break
        # Equal ranges between the least and the greatest value of the cell. A cell that spans the whole double range
        # makes the quotient NaN, which lands in the last range; any monotone numbering is right.
        parts = max(16, min(MAX_SUB_CELLS, ROUND_CELLS // max(1, size["cells"])))
        position = (F.col("value") - F.col("low")) / (F.col("high") - F.col("low")) * parts
        sub = F.when(position < parts, F.floor(position)).otherwise(parts - 1).cast("bigint")
        long = long.withColumn("parent", F.col("cell")).withColumn("cell", F.col("cell") * parts + sub)
        finer = _cell_sums(long, "parent", "tn", "ts", "before_n", "before_s")
        finer = _running(finer, ["node", "feature", "parent"]).withColumns(
            {"cum_n": F.col("cum_n") + F.col("before_n"), "cum_s": F.col("cum_s") + F.col("before_s")}
        )
        cells = keep(_threshold_splits(finer, "high", "next_low"))
        found = found.unionByName(cells.select(*_SPLIT), allowMissingColumns=True)
        best = found.groupBy("node").agg(F.coalesce(F.max("gain"), F.lit(0.0)).alias("best"))
        still_open = cells.filter("low < high").join(best, "node").filter(_inner_bound() >= F.col("best") * _SLACK)
        long = long.select("node", "y", "feature", "value", "cell")

    carried = [] if edges is not None else [F.first(c).alias(c) for c in ("tn", "ts", "before_n", "before_s")]
    values = long.groupBy(*_CELL, "value").agg(F.count("*").alias("n"), F.sum("y").alias("s"), *carried)
    if edges is not None:
        values = values.join(edges.drop("low", "high"), _CELL)
    in_order = Window.partitionBy(*_CELL).orderBy("value")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = values.withColumns(
        {
            "next_value": F.lead("value").over(in_order),
            "cum_n": F.sum("n").over(so_far) + F.col("before_n"),
            "cum_s": F.sum("s").over(so_far) + F.col("before_s"),
        }
    ).filter(F.col("next_value").isNotNull())
    return found.unionByName(_threshold_splits(inside, "value", "next_value").select(*_SPLIT), allowMissingColumns=True)
