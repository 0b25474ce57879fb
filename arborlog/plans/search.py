"""Parameter search on a fixed validation part."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import Any, NamedTuple

import pyarrow as pa
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborlog.plans.tree import fit_tree, score_depths
from arborlog.session import local_table

# Up to this size fits run side by side; their results do not depend on it.
PARALLEL_FIT_ROWS = 2_000_000

_RESULT = pa.schema([("params", pa.string()), ("value", pa.float64()), ("is_best", pa.bool_())])


class SearchResult(NamedTuple):
    table: DataFrame
    params: dict[str, Any]
    model: Any


def grid_search(
    train: DataFrame,
    validation: DataFrame,
    grid: Sequence[Mapping[str, Any]],
    fit: Callable[..., Any],
    label: str,
    parallelism: int | None = None,
) -> SearchResult:
    """Fit one model per entry of ``grid`` and take the one with the lowest RMSE on ``validation``; the first wins ties.

    ``fit(train, **params)`` gives a model of Spark ML. Both parts are persisted once, and one pass over the validation part
    scores all models. On a small table the fits run side by side, as one alone leaves cores idle; on a large one they run one
    after another, as every fit of Spark ML holds its own copy of the rows. The table is ``params, value, is_best``.
    """
    spark = train.sparkSession
    train = train.persist(StorageLevel.MEMORY_AND_DISK)
    validation = validation.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if parallelism is None:
            parallelism = len(grid) if train.count() < PARALLEL_FIT_ROWS else 1
        run = inheritable_thread_target(spark)(lambda params: fit(train, **params))
        with ThreadPoolExecutor(max_workers=min(parallelism, len(grid))) as pool:
            models = list(pool.map(run, grid))
        scored = validation
        for i, model in enumerate(models):
            scored = model.copy().setPredictionCol(f"_p{i}").transform(scored)
        errors = scored.agg(
            *[F.sqrt(F.avg(F.pow(F.col(f"_p{i}") - F.col(label), 2))).alias(f"e{i}") for i in range(len(models))]
        ).first()
    finally:
        train.unpersist()
        validation.unpersist()
    best = min(range(len(models)), key=lambda i: errors[i] if errors[i] is not None else float("inf"))
    rows = [(json.dumps(dict(p), sort_keys=True), errors[i], i == best) for i, p in enumerate(grid)]
    return SearchResult(local_table(spark, _RESULT, rows), dict(grid[best]), models[best])


def nested_search(
    train: DataFrame, validation: DataFrame, features: Sequence[str] | str, label: str, depths: Sequence[int], **params
) -> SearchResult:
    """The depth of an exact tree with the lowest RMSE on ``validation``; the first wins ties.

    A tree of some depth is the upper part of a deeper one, so the deepest is fitted once and one pass over the validation part scores
    all depths from the means of its nodes. ``params`` go to ``fit_tree``. The table is that of ``grid_search``.
    """
    spark = train.sparkSession
    model = fit_tree(train, features, label, max(depths), **params)
    names = {f"_p{i}": d for i, d in enumerate(depths)}
    scored = score_depths(validation, model, names, features)
    errors = scored.agg(*[F.sqrt(F.avg(F.pow(F.col(p) - F.col(label), 2))).alias(p) for p in names]).first()
    best = min(range(len(depths)), key=lambda i: errors[i] if errors[i] is not None else float("inf"))
    rows = [(json.dumps({"max_depth": d}), errors[i], i == best) for i, d in enumerate(depths)]
    return SearchResult(local_table(spark, _RESULT, rows), {"max_depth": depths[best]}, model.pruned(depths[best]))
