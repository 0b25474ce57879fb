"""Exact regression tree, grown level by level.

One level is a fixed number of jobs for all its large nodes together. The training rows are persisted once and never copied per
node: their node follows from the splits found so far, one broadcast join of at most 2^level rows per level. Rows of finished leaves
drop out in that join. A node whose rows fit into one task is set aside: at the end the rows of all these nodes are laid out by node,
in one shuffle, and each task grows the whole rest below its nodes. So deep levels take no jobs of their own, and every node that
is searched in cells has many rows per cell.

Features may be categorical: their splits are sets of categories.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence
from dataclasses import dataclass
from typing import NamedTuple

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type

from arborlog.functions.buckets import bucket_count
from arborlog.functions.text import number, quoted
from arborlog.operators.subtrees import grow_subtrees
from arborlog.operators.splits import CELL_ROWS, MAX_ARITY, cell_bounds, centered, level_splits, with_cells
from arborlog.session import broadcast_if_small, local_table, reliable_checkpoint

# The chain of joins is cut by a checkpoint after this many levels.
CHECKPOINT_EVERY = 8
# A node with at most so many feature values (rows times features, 32 MB) is grown to its end by one task.
LOCAL_VALUES = 4_000_000

# The wording of a rule listing.
LEFT_RULE = "If feature[{}] <= {:.2f}"
RIGHT_RULE = "Else feature[{}] > {:.2f}"
LEFT_SET_RULE = "If feature[{}] in {{{}}}"
RIGHT_SET_RULE = "Else feature[{}] not in {{{}}}"
LEAF_RULE = "Predict: {:.2f}"

_TABLE = pa.schema(
    [
        ("node_id", pa.int64()),
        ("depth", pa.int32()),
        ("feature", pa.int32()),
        ("threshold", pa.float64()),
        ("gain", pa.float64()),
        ("n", pa.int64()),
        ("prediction", pa.float64()),
    ]
)
_SUBSET = pa.field("subset", pa.int64())
_STEP = pa.schema(
    [
        ("_node", pa.int64()),
        ("_feature", pa.int32()),
        ("_threshold", pa.float64()),
        ("_subset", pa.int64()),
        ("_left", pa.int32()),
        ("_right", pa.int32()),
    ]
)
# What becomes of the rows of a child: none are needed, searched on the next level, set aside.
_LEAF_ROWS, _ACTIVE, _ASIDE = 0, 1, 2
_TEST = pa.schema([_STEP.field(i) for i in range(4)])
_VISITED = _TEST.append(pa.field("_own", pa.float64()))
_LEAF = pa.schema([("_node", pa.int64()), ("_leaf", pa.float64())])
_RULE = pa.schema([("position", pa.int32()), ("node_id", pa.int64()), ("depth", pa.int32()), ("rule", pa.string())])
_IMPORTANCE = pa.schema([("feature", pa.string()), ("importance", pa.float64())])


class TreeNode(NamedTuple):
    """One node. The children of node k are 2k (feature <= threshold, or in the subset) and 2k + 1; a leaf has no feature.

    ``subset`` holds the categories that go left as bits; only a split of a categorical feature has one, in place of a threshold.
    """

    node_id: int
    depth: int
    feature: int | None
    threshold: float | None
    gain: float | None
    n: int
    prediction: float
    subset: int | None = None


def categories(subset: int) -> list[int]:
    """The categories of a subset."""
    return [k for k in range(MAX_ARITY) if subset >> k & 1]


@dataclass(frozen=True)
class TreeModel:
    features: tuple[str, ...]
    nodes: tuple[TreeNode, ...]
    categorical: tuple[int, ...] = ()

    @classmethod
    def from_table(cls, table: DataFrame, features: Sequence[str]) -> TreeModel:
        """Rebuild a model from its stored table."""
        subset = [_SUBSET.name] if _SUBSET.name in table.columns else []
        rows = table.select(*_TABLE.names, *subset).orderBy("node_id").collect()
        nodes = tuple(TreeNode(*r) for r in rows)
        return cls(tuple(features), nodes, tuple(sorted({n.feature for n in nodes if n.subset is not None})))

    def table(self, spark: SparkSession) -> DataFrame:
        """``node_id, depth, feature, threshold, gain, n, prediction``, and ``subset`` if a feature is categorical."""
        schema = _TABLE.append(_SUBSET) if self.categorical else _TABLE
        return local_table(spark, schema, list(self.nodes))

    def pruned(self, depth: int) -> TreeModel:
        """The tree as a fit to this depth gives it: deeper nodes go, and those at ``depth`` become leaves."""
        kept = [n if n.depth < depth else n._replace(feature=None, threshold=None, gain=None, subset=None) for n in self.nodes if n.depth <= depth]
        return TreeModel(self.features, tuple(kept), self.categorical)

    def importance(self, spark: SparkSession) -> DataFrame:
        """``feature, importance``: gain times rows of the splits of each feature, as shares of 1."""
        gains = [0.0] * len(self.features)
        for node in self.nodes:
            if node.feature is not None:
                gains[node.feature] += node.gain * node.n
        total = sum(gains) or 1.0
        return local_table(spark, _IMPORTANCE, [(f, g / total) for f, g in zip(self.features, gains)])

    def rules(self, spark: SparkSession, inverse: Callable[[float], float] | None = None) -> DataFrame:
        """``position, node_id, depth, rule``: the tree as indented text, top down and left first.

        ``inverse`` maps a predicted value to its original unit.
        """
        by_id = {n.node_id: n for n in self.nodes}
        lines: list[tuple[int, int, str]] = []
        # Entries are (node, text to print before it); a stack replaces recursion.
        waiting = [(1, None)] if by_id else []
        while waiting:
            node_id, heading = waiting.pop()
            node = by_id[node_id]
            if heading is not None:
                lines.append((node_id // 2, node.depth - 1, heading))
            if node.feature is None:
                value = inverse(node.prediction) if inverse else node.prediction
                lines.append((node_id, node.depth, LEAF_RULE.format(value)))
            elif node.subset is not None:
                own = ", ".join(map(str, categories(node.subset)))
                waiting.append((2 * node_id + 1, RIGHT_SET_RULE.format(node.feature, own)))
                waiting.append((2 * node_id, LEFT_SET_RULE.format(node.feature, own)))
            else:
                waiting.append((2 * node_id + 1, RIGHT_RULE.format(node.feature, node.threshold)))
                waiting.append((2 * node_id, LEFT_RULE.format(node.feature, node.threshold)))
        return local_table(
            spark, _RULE, [(i, node_id, depth, " " * 4 * depth + text) for i, (node_id, depth, text) in enumerate(lines)]
        )


def feature_exprs(df: DataFrame, features: Sequence[str] | str) -> tuple[DataFrame, list[str], list[str]]:
    """Names and double expression texts of the features, which are column names or one array or vector column.

    A vector is unpacked into a helper column of the returned table.
    """
    if not isinstance(features, str):
        return df, list(features), [f"CAST({quoted(c)} AS DOUBLE)" for c in features]
    packed = features
    if isinstance(df.schema[features].dataType, VectorUDT):
        packed = "_unpacked"
        df = df.withColumn(packed, vector_to_array(features))
    first = df.select(F.size(packed).alias("width")).first()
    width = first["width"] if first else 0
    return (
        df,
        [f"{features}[{i}]" for i in range(width)],
        [f"CAST(get({quoted(packed)}, {i}) AS DOUBLE)" for i in range(width)],
    )


def fit_tree(
    df: DataFrame,
    features: Sequence[str] | str,
    label: str,
    max_depth: int = 10,
    buckets: int | None = None,
    cell_rows: int = CELL_ROWS,
    checkpoint_every: int = CHECKPOINT_EVERY,
    arity: Mapping[str, int] | None = None,
    local_values: int = LOCAL_VALUES,
) -> TreeModel:
    """Grow a regression tree over every midpoint between distinct feature values.

    ``arity`` names categorical features, which hold 0 … k − 1 (k at most 63); they are split by sets of categories, the best of all
    sets. A node becomes a leaf with the mean label at ``max_depth``, when its labels are all equal, or when no split has a gain above
    rounding. Equal gains go to the first feature, then to the lowest threshold or the fewest categories. Features and label must be
    free of null and NaN. A node of at most ``local_values`` feature values is grown by one task.
    """
    spark = df.sparkSession
    df, names, exprs = feature_exprs(df, features)
    sizes = {names.index(c): k for c, k in (arity or {}).items()}
    if any(not 0 < k <= MAX_ARITY for k in sizes.values()):
        raise ValueError(f"a categorical feature has 1 to {MAX_ARITY} categories")
    categorical, width = sorted(sizes), len(names)
    whole_number = isinstance(df.schema[label].dataType, T.IntegralType)
    y = f"CAST({quoted(label)} AS {'BIGINT' if whole_number else 'DOUBLE'}) AS y"
    n, total, mean, rows = _checked(df.selectExpr(y, *[f"{x} AS x{i}" for i, x in enumerate(exprs)]), width, whole_number, sizes)
    if n == 0:
        return TreeModel(tuple(names), (), tuple(categorical))

    nodes: list[TreeNode] = []
    # Nodes that wait for their split: number -> (rows, label sum).
    active, aside = {}, []

    def place(node: int, own_n: int, own_total) -> int:
        """Make a node a leaf, or let it wait; returns what becomes of its rows."""
        depth = node.bit_length() - 1
        if depth >= max_depth:
            nodes.append(TreeNode(node, depth, None, None, None, own_n, own_total / own_n + mean))
            return _LEAF_ROWS
        if own_n * width <= local_values:
            aside.append(node)
            return _ASIDE
        active[node] = own_n, own_total
        return _ACTIVE

    state = place(1, n, total)
    if state == _LEAF_ROWS:
        return TreeModel(tuple(names), tuple(nodes), tuple(categorical))
    if state == _ACTIVE:
        buckets = buckets or bucket_count(n)
        rows = with_cells(rows, width, cell_bounds(rows, width, buckets, n, categorical), categorical)
        cores = spark.sparkContext.defaultParallelism
        if rows.rdd.getNumPartitions() < cores:
            # One or two files, say; the levels should use more cores than that.
            rows = rows.repartition(cores)
    # The node number is stored too: as a constant of the plan it would turn the first join into a nested loop.
    level = base = rows.withColumns({"node": F.lit(1).cast("bigint"), "state": F.lit(state)})
    if state == _ACTIVE:
        base.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        depth = 0
        while active:
            waiting, active = active, {}
            held: list[DataFrame] = []
            try:
                halvings = _halvings(2 * len(waiting), buckets)
                searched = level.filter(F.col("state") == _ACTIVE)
                found = level_splits(searched, width, _keeper(held), cell_rows, halvings, categorical).collect()
            finally:
                for cells in held:
                    cells.unpersist()
            # Rows that were set aside pass on as they are.
            steps = [(k, None, None, None, _ASIDE, _ASIDE) for k in aside]
            for r in found:
                own_n, own_total = waiting[r.node]
                gone = r.feature is None
                nodes.append(TreeNode(r.node, depth, r.feature, r.threshold, r.gain, own_n, own_total / own_n + mean, r.subset))
                if not gone:
                    left = place(2 * r.node, r.left_n, r.left_total)
                    right = place(2 * r.node + 1, own_n - r.left_n, own_total - r.left_total)
                    steps.append((r.node, r.feature, r.threshold, r.subset, left, right))
            depth += 1
            if not active and not aside:
                break
            level = _descend(level, local_table(spark, _STEP, steps), len(steps), width, categorical)
            if depth % checkpoint_every == 0 and active:
                level = reliable_checkpoint(level)
                base.unpersist()
        if aside:
            rest = level.filter(F.col("state") == _ASIDE).select("node", "y", *[f"x{i}" for i in range(width)])
            nodes += [
                TreeNode(r.node_id, r.node_id.bit_length() - 1, r.feature, r.threshold, r.gain, r.n, r.mean + mean, r.subset)
                for r in grow_subtrees(rest, width, max_depth, sizes).collect()
            ]
    finally:
        base.unpersist()
    return TreeModel(tuple(names), tuple(sorted(nodes, key=lambda node: node.node_id)), tuple(categorical))


def _keeper(held: list[DataFrame]) -> Callable[[DataFrame], DataFrame]:
    def keep(cells: DataFrame) -> DataFrame:
        held.append(cells.persist(StorageLevel.MEMORY_AND_DISK))
        return cells

    return keep


def _halvings(nodes: int, buckets: int) -> int:
    """How often to merge neighbouring cells so that all nodes together have about as many as the root; 16 stay at least."""
    return max(0, min((nodes // 2).bit_length() - 1, buckets.bit_length() - 5))


def _checked(rows: DataFrame, width: int, whole_number: bool, sizes: Mapping[int, int]) -> tuple[int, float, float, DataFrame]:
    """Count and sum of the rows; refuses null, NaN and what is no category. Whole-number labels stay whole while their sum fits.

    Other labels are returned relative to their mean, the third value.
    """
    unfit = " OR ".join(f"{c} IS NULL OR isnan(CAST({c} AS DOUBLE))" for c in ["y", *[f"x{i}" for i in range(width)]])
    strange = " OR ".join(f"NOT (x{i} >= 0 AND x{i} < {k} AND x{i} = floor(x{i}))" for i, k in sizes.items()) or "false"
    row = rows.selectExpr(
        "count(*) AS n",
        f"count_if({unfit}) AS bad",
        f"count_if({strange}) AS strange",
        "max(abs(CAST(y AS DOUBLE))) AS largest",
        "avg(CAST(y AS DOUBLE)) AS mean",
        "try_sum(y) AS total",
    ).first()
    if row["bad"]:
        raise ValueError(f"{row['bad']} rows have a null or NaN in a feature or the label; drop or fill them first")
    if row["strange"]:
        raise ValueError(f"{row['strange']} rows have a value that is no category of its feature")
    if whole_number and row["n"] * (row["largest"] or 0.0) < 2.0**62:
        return row["n"], row["total"] or 0, 0.0, rows
    return row["n"], 0.0, row["mean"] or 0.0, centered(rows, row["mean"])


def _goes_left(values: Sequence[str], categorical: Collection[int] = ()) -> str:
    """The test of a node on the value of its own feature; a missing value or an unknown category fails it."""

    def test(i: int, x: str) -> str:
        if i not in categorical:
            return f"{x} <= _threshold"
        return f"{x} >= 0 AND {x} < {MAX_ARITY} AND (shiftright(_subset, CAST({x} AS INT)) & 1) = 1"

    cases = " ".join(f"WHEN {i} THEN {test(i, x)}" for i, x in enumerate(values))
    return f"(CASE _feature {cases} END)"


def _descend(level: DataFrame, steps: DataFrame, count: int, width: int, categorical: Collection[int]) -> DataFrame:
    """Move rows of split nodes to their children, drop the rows of leaves, and pass on the rows of nodes without a test."""
    left = _goes_left([f"x{i}" for i in range(width)], categorical)
    return (
        level.join(broadcast_if_small(steps.withColumnRenamed("_node", "node"), count), "node")
        .withColumn("left", F.expr(left))
        .withColumns(
            {
                "node": F.expr("CASE WHEN _feature IS NULL THEN node WHEN left THEN 2 * node ELSE 2 * node + 1 END"),
                "state": F.expr("CASE WHEN left THEN _left ELSE _right END"),
            }
        )
        .filter(F.col("state") > _LEAF_ROWS)
        .drop("left", "_feature", "_threshold", "_subset", "_left", "_right")
    )


def score_depths(df: DataFrame, model: TreeModel, depths: Mapping[str, int], features: Sequence[str] | str | None = None) -> DataFrame:
    """Add one prediction per entry of ``depths`` (output name -> depth): that of the tree fitted to this depth only.

    All come from one walk down the tree, as every node carries the mean of its rows.
    """
    spark = df.sparkSession
    if not model.nodes:
        return df.withColumns({name: F.lit(None).cast("double") for name in depths})
    kept = [F.col(quoted(c)) for c in df.columns if c not in depths]
    df, _, exprs = feature_exprs(df, list(model.features) if features is None else features)
    left = _goes_left(exprs, model.categorical)
    move = F.expr(f"CASE WHEN _feature IS NULL THEN _node WHEN {left} THEN 2 * _node ELSE 2 * _node + 1 END")
    root = model.nodes[0]
    scored = df.withColumns({"_node": F.lit(1).cast("bigint"), "_mean": F.lit(None).cast("double")})
    for depth in range(1 + max(depths.values())):
        rows = [(n.node_id, n.feature, n.threshold, n.subset, n.prediction) for n in model.nodes if n.depth == depth]
        if depth == 0:
            (own,) = rows  # which all rows visit
            scored = scored.withColumns({f.name: F.lit(v).cast(from_arrow_type(f.type)) for f, v in zip(_VISITED, own) if f.name != "_node"})
        else:
            scored = scored.join(broadcast_if_small(local_table(spark, _VISITED, rows), len(rows)), "_node", "left")
        # Below a leaf its mean stays.
        scored = scored.withColumn("_mean", F.coalesce("_own", "_mean"))
        scored = scored.withColumns({name: F.col("_mean") for name, d in depths.items() if d == depth} | {"_node": move}).drop(*_VISITED.names[1:])
    return scored.select(*kept, *depths)


def score_tree(
    df: DataFrame,
    model: TreeModel,
    features: Sequence[str] | str | None = None,
    inverse: Callable[[Column], Column] | None = None,
    output: str = "prediction",
) -> DataFrame:
    """Add the prediction of a tree: left at feature <= threshold, else right.

    ``features`` defaults to the columns the model was fitted on. ``inverse`` maps the leaf value to its original unit, for
    example ``unlog_label``. One broadcast join per level and one for the leaves, in one generated stage; nothing is
    shuffled.
    """
    spark = df.sparkSession
    if not model.nodes:
        return df.withColumn(output, F.lit(None).cast("double"))
    if features is None:
        features = list(model.features)
    kept = [F.col(quoted(c)) for c in df.columns if c != output]
    df, _, exprs = feature_exprs(df, features)
    move = F.expr(
        f"CASE WHEN _feature IS NULL THEN _node WHEN {_goes_left(exprs, model.categorical)} THEN 2 * _node ELSE 2 * _node + 1 END"
    )
    root = model.nodes[0]
    if root.feature is None:
        value = F.lit(root.prediction)
        return df.withColumn(output, inverse(value) if inverse else value).select(*kept, output)
    # The root is one test for all rows and needs no join.
    x = exprs[root.feature]
    if root.subset is None:
        test = f"{x} <= {number(root.threshold)}"
    else:
        test = f"{x} >= 0 AND {x} < {MAX_ARITY} AND (shiftright({root.subset}L, CAST({x} AS INT)) & 1) = 1"
    scored = df.withColumn("_node", F.expr(f"CASE WHEN {test} THEN 2 ELSE 3 END").cast("bigint"))
    for depth in range(1, max(n.depth for n in model.nodes)):
        splits = [(n.node_id, n.feature, n.threshold, n.subset) for n in model.nodes if n.depth == depth and n.feature is not None]
        step = broadcast_if_small(local_table(spark, _TEST, splits), len(splits))
        scored = scored.join(step, "_node", "left").withColumn("_node", move).drop(*_TEST.names[1:])
    leaves = [(n.node_id, n.prediction) for n in model.nodes if n.feature is None]
    value = F.col("_leaf")
    return (
        scored.join(broadcast_if_small(local_table(spark, _LEAF, leaves), len(leaves)), "_node", "left")
        .withColumn(output, inverse(value) if inverse else value)
        .select(*kept, output)
    )
