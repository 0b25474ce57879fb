"""Logistic regression by batch gradient descent and by L-BFGS.

A step takes one pass: every task adds up its own vector of the gradient and the loss, from Arrow batches, and passes on one row. The
weights reach the tasks as one array, so a step makes no new code, whatever the number of features. The steps themselves are
arithmetic on vectors of model size.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arborlog.functions.linear import dot, hard_label, sigmoid
from arborlog.functions.text import literal, quoted
from arborlog.plans.tree import feature_exprs
from arborlog.session import local_table

INTERCEPT = "intercept"

_TERMS = pa.schema([("term", pa.string()), ("value", pa.float64())])


@dataclass(frozen=True)
class LinearModel:
    features: tuple[str, ...]
    coefficients: tuple[float, ...]
    intercept: float

    def terms(self, spark: SparkSession) -> DataFrame:
        """``term, value`` with the intercept last."""
        return local_table(spark, _TERMS, [*zip(self.features, self.coefficients), (INTERCEPT, self.intercept)])


def _chance(features: Sequence[str], weights: Sequence[float]) -> Column:
    """Predicted probability from expression texts; the last weight is the bias."""
    return sigmoid(dot(features, weights[:-1]) + F.lit(float(weights[-1])))


def _packed(df: DataFrame, exprs: Sequence[str], label: str) -> DataFrame:
    """``x, y``: features as one array, label as double."""
    return df.selectExpr(f"array({', '.join(exprs)}) AS x" if exprs else "CAST(array() AS array<double>) AS x", f"CAST({quoted(label)} AS DOUBLE) AS y")


def _partial_sums(rows: DataFrame, weights: Sequence[float]) -> DataFrame:
    """One row per task: ``sums``, the summed gradient with the bias's last, then the summed log loss. ``rows`` hold no null."""
    w = np.array(weights, np.float64)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(len(w) + 1)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(w) - 1)
            y = batch.column(1).to_numpy(zero_copy_only=False)
            z = x @ w[:-1] + w[-1]
            with np.errstate(over="ignore"):
                error = 1 / (1 + np.exp(-z)) - y
            sums[:-2] += error @ x
            sums[-2] += error.sum()
            sums[-1] += (np.logaddexp(0, z) - y * z).sum()
        yield pa.record_batch([pa.array([sums], pa.list_(pa.float64()))], ["sums"])

    return rows.mapInArrow(add_up, "sums array<double>")


def _sums(rows: DataFrame, weights: Sequence[float]) -> np.ndarray:
    """The sums of all tasks, added up per position before they reach the driver."""
    added = _partial_sums(rows, weights).select(F.posexplode("sums").alias("pos", "value")).groupBy("pos").agg(F.sum("value").alias("value"))
    out = np.zeros(len(weights) + 1)
    for r in added.collect():
        out[r["pos"]] = r["value"]
    return out


def gradient(df: DataFrame, features: Sequence[str] | str, label: str, weights: Sequence[float]) -> DataFrame:
    """``term, g``: summed gradient (sigmoid(w · x) − y) · x of the log loss, bias last. Rows with a null are left out.

    Every task passes on one vector of sums.
    """
    df, names, exprs = feature_exprs(df, features)
    terms = [*names, INTERCEPT]
    named = F.element_at(F.expr(f"array({', '.join(map(literal, terms))})"), F.col("pos") + 1)
    rows = _packed(df, exprs, label).filter(F.col("y").isNotNull() & ~F.exists("x", lambda v: v.isNull()))
    sums = _partial_sums(rows, weights).select(F.posexplode(F.slice("sums", 1, len(terms))).alias("pos", "value"))
    return sums.groupBy("pos").agg(F.sum("value").alias("g")).select(named.alias("term"), "g")


def _checked_rows(rows: DataFrame) -> int:
    """The row count; refuses null and NaN."""
    unfit = F.exists("x", lambda v: v.isNull() | F.isnan(v)) | F.col("y").isNull() | F.isnan("y")
    seen = rows.agg(F.count("*").alias("n"), F.count_if(unfit).alias("bad")).first()
    if seen["bad"]:
        raise ValueError(f"{seen['bad']} rows have a null or NaN in a feature or the label; drop or fill them first")
    return seen["n"]


def fit_logistic_gd(
    df: DataFrame,
    features: Sequence[str] | str,
    label: str,
    step: float = 0.01,
    iterations: int = 100,
    reduce: str = "sum",
) -> LinearModel:
    """Batch gradient descent from zero weights with a fixed step and a fixed number of iterations.

    ``reduce='sum'`` steps along the summed gradient, ``'mean'`` along the mean gradient, whose step does not depend on the
    row count. No scaling and no penalty: apply ``zscore`` before, if wanted. Every iteration is one aggregate over the
    persisted rows. Features and label must be free of null and NaN.
    """
    if reduce not in ("sum", "mean"):
        raise ValueError(f"reduce must be sum or mean, not {reduce!r}")
    df, names, exprs = feature_exprs(df, features)
    rows = _packed(df, exprs, label).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n = _checked_rows(rows)
        scale = 1.0 if reduce == "sum" else 1.0 / max(1, n)
        weights = np.zeros(len(names) + 1)
        for _ in range(iterations):
            weights = weights - step * scale * _sums(rows, weights)[:-1]
    finally:
        rows.unpersist()
    return LinearModel(tuple(names), tuple(weights[:-1].tolist()), float(weights[-1]))


def fit_logistic_lbfgs(
    df: DataFrame,
    features: Sequence[str] | str,
    label: str,
    penalty: float = 0.0,
    standardize: bool = True,
    max_iter: int = 100,
    tol: float = 1e-9,
    memory: int = 10,
) -> LinearModel:
    """Logistic regression with intercept by L-BFGS: mean log loss plus ``penalty`` / 2 · |coefficients|².

    With ``standardize`` coefficients are those of features divided by their standard deviation while they are fitted and
    penalised (as the library does it; a constant feature gets 0); they are returned for the features as they are. Stops
    when no partial derivative is larger than ``tol``, or no step gets lower. Each evaluation of loss and gradient is one pass over the persisted rows. Features and label must
    be free of null and NaN; a table without rows gives zeros.
    """
    df, names, exprs = feature_exprs(df, features)
    rows = _packed(df, exprs, label).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n = _checked_rows(rows)
        scale = np.ones(len(names) + 1)
        if standardize and n and names:
            spread = rows.select(F.posexplode("x").alias("pos", "v")).groupBy("pos").agg(F.stddev_samp("v").alias("s"))
            for r in spread.collect():
                scale[r["pos"]] = 1 / r["s"] if r["s"] else 0.0
        pull = np.append(np.full(len(names), penalty), 0.0)

        def evaluate(u: np.ndarray) -> tuple[float, np.ndarray]:
            sums = _sums(rows, u * scale) / max(1, n)
            return float(sums[-1] + (pull * u * u).sum() / 2), sums[:-1] * scale + pull * u

        u = _lbfgs(evaluate, np.zeros(len(names) + 1), max_iter, tol, memory) * scale
    finally:
        rows.unpersist()
    return LinearModel(tuple(names), tuple(u[:-1].tolist()), float(u[-1]))


def _lbfgs(evaluate: Callable[[np.ndarray], tuple[float, np.ndarray]], u: np.ndarray, max_iter: int, tol: float, memory: int) -> np.ndarray:
    """Minimise a smooth convex function. The last ``memory`` steps and their changes of the gradient stand for the curvature."""
    value, slope = evaluate(u)
    steps: deque[tuple[np.ndarray, np.ndarray, float]] = deque(maxlen=memory)
    for _ in range(max_iter):
        if np.abs(slope).max() <= tol:
            break
        direction, shares = -slope, []
        for s, y, inverse in reversed(steps):
            shares.append(inverse * (s @ direction))
            direction = direction - shares[-1] * y
        if steps:
            s, y, inverse = steps[-1]
            direction = direction / (inverse * (y @ y))
        for s, y, inverse in steps:
            direction = direction + (shares.pop() - inverse * (y @ direction)) * s
        down = slope @ direction
        if down >= 0:
            steps.clear()
            direction, down = -slope, -(slope @ slope)
        length = 1.0 if steps else min(1.0, 1.0 / np.abs(slope).sum())
        for _ in range(30):
            tried_value, tried_slope = evaluate(u + length * direction)
            # Near the optimum the loss changes by less than its rounding; there the slope decides.
            flat = abs(tried_value - value) <= 1e-12 * abs(value) and abs(tried_slope @ direction) <= abs(down)
            if tried_value <= value + 1e-4 * length * down or flat:
                break
            length /= 2
        else:
            break
        s, y = length * direction, tried_slope - slope
        u, value, slope = u + s, tried_value, tried_slope
        if s @ y > 1e-18:
            steps.append((s, y, 1 / (s @ y)))
    return u


def score_logistic(
    df: DataFrame, model: LinearModel, features: Sequence[str] | str | None = None, threshold: float = 0.5
) -> DataFrame:
    """Add ``probability`` and the hard ``prediction``, 1.0 from the threshold on."""
    if features is None:
        features = list(model.features)
    columns = df.columns
    df, _, exprs = feature_exprs(df, features)
    scored = df.withColumn("probability", _chance(exprs, [*model.coefficients, model.intercept]))
    scored = scored.withColumn("prediction", hard_label(F.col("probability"), threshold))
    kept = [F.col(quoted(c)) for c in columns if c not in ("probability", "prediction")]
    return scored.select(*kept, "probability", "prediction")
