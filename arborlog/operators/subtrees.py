"""Regression trees of many small nodes, each grown to its end by one task."""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from arborlog.operators.splits import _DIGITS, _LEAST_GAIN

_NODES = pa.schema(
    [
        ("node_id", pa.int64()),
        ("feature", pa.int32()),
        ("threshold", pa.float64()),
        ("gain", pa.float64()),
        ("n", pa.int64()),
        ("mean", pa.float64()),
        ("subset", pa.int64()),
    ]
)
_NODES_DDL = "node_id bigint, feature int, threshold double, gain double, n bigint, mean double, subset bigint"


def grow_subtrees(rows: DataFrame, width: int, max_depth: int, sizes: Mapping[int, int]) -> DataFrame:
    """All nodes below and with those of ``rows`` (``node, y, x0 …``): ``node_id, feature, threshold, gain, n, mean, subset``.

    The same splits as ``level_splits`` finds. One shuffle lays the rows out by node; the rows of a node meet in one task, so the caller
    sees to it that they fit. ``sizes`` are the numbers of categories of categorical features.
    """
    own_sizes = dict(sizes)

    def grow(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        return _grow(key[0].as_py(), table, width, max_depth, own_sizes)

    return rows.groupBy("node").applyInArrow(grow, _NODES_DDL)


def _grow(root: int, table: pa.Table, width: int, max_depth: int, sizes: dict[int, int]) -> pa.Table:
    y = table.column("y").to_numpy()
    x = [table.column(f"x{i}").to_numpy() for i in range(width)]
    # The rows in the order of each feature, kept in that order from node to node.
    orders = [np.arange(len(y)) if i in sizes else np.argsort(x[i], kind="stable") for i in range(width)]
    out = []
    waiting = [(root, orders)]
    while waiting:
        node, orders = waiting.pop()
        labels = y[orders[0]]
        n, total = len(labels), labels.sum(dtype=_exact(y))
        best = None
        if node.bit_length() <= max_depth and labels.min() < labels.max():
            best = _best(x, y, orders, sizes, float(n), float(total), labels)
        feature, threshold, subset, gain = best or (None, None, None, None)
        out.append((node, feature, threshold, gain, n, float(total) / n, subset))
        if best:
            if subset is None:
                left = x[feature] <= threshold
            else:
                left = (subset >> x[feature].astype(np.int64) & 1).astype(bool)
            waiting.append((2 * node, [o[left[o]] for o in orders]))
            waiting.append((2 * node + 1, [o[~left[o]] for o in orders]))
    return pa.table([pa.array([r[i] for r in out], f.type) for i, f in enumerate(_NODES)], schema=_NODES)


def _exact(y: np.ndarray) -> type:
    """Whole numbers add up exactly; real ones with some digits to spare, so that the order of rows does not show."""
    return np.int64 if y.dtype.kind == "i" else np.longdouble


def _best(x, y, orders, sizes, tn: float, ts: float, labels: np.ndarray) -> tuple | None:
    """The best split of a node, (feature, threshold, subset, gain), by the rules of ``splits``."""
    exact = _exact(y)
    best, best_rank = None, None
    for i, order in enumerate(orders):
        values, own = x[i][order], y[order]
        if i in sizes:
            codes = values.astype(np.int64)
            counts = np.bincount(codes, minlength=sizes[i])
            sums = np.zeros(sizes[i], exact)
            np.add.at(sums, codes, own)
            met = np.flatnonzero(counts)
            met = met[np.lexsort((met, sums[met].astype(float) / counts[met]))]
            ln, ls = np.cumsum(counts[met])[:-1].astype(float), np.cumsum(sums[met])[:-1].astype(float)
        else:
            at = np.flatnonzero(values[1:] != values[:-1])
            ln, ls = (at + 1).astype(float), np.cumsum(own, dtype=exact)[at].astype(float)
        if not len(ln):
            continue
        gap = ls / ln - (ts - ls) / (tn - ln)
        gain = ln * (tn - ln) / (tn * tn) * (gap * gap)
        k = int(gain.argmax())
        if not gain[k] > 0:
            continue
        rank = (gain[k],)
        if exact is not np.int64:
            near = np.flatnonzero(gain >= gain[k] * (1 - 1e-9))
            power = np.floor(np.log10(gain[near]))
            size = np.round(gain[near] * 10.0 ** (_DIGITS - 1 - power))
            first = int(np.lexsort((np.arange(len(near)), -size, -power))[0])
            k, rank = int(near[first]), (power[first], size[first])
        if best is None or rank > best_rank:
            if i in sizes:
                split = i, None, sum(1 << int(c) for c in met[: k + 1]), float(gain[k])
            else:
                low, high = values[at[k]], values[at[k] + 1]
                middle = (low + high) / 2
                split = i, float(middle if middle < high else low), None, float(gain[k])
            best, best_rank = split, rank
    if best is None:
        return None
    variance = max(0.0, float((labels.astype(float) ** 2).sum()) / tn - (ts / tn) ** 2)
    return best if best[3] > _LEAST_GAIN * variance else None
