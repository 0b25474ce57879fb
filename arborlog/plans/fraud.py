"""Card-fraud job: read, split, train a logistic regression, report on both parts."""

from __future__ import annotations

from typing import NamedTuple

from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arborlog.functions.encode import assemble, feature_columns
from arborlog.operators.metrics import metric_report
from arborlog.operators.moments import moments, moments_map, zscore
from arborlog.operators.sampling import hash_split
from arborlog.plans.library import as_linear_model, fit_logistic
from arborlog.plans.logistic import LinearModel, fit_logistic_gd, score_logistic
from arborlog.sources.delimited import read_labelled

# The split, and step and iterations of the gradient descent.
TRAIN_SHARE, SEED = 0.8, 24
STEP, ITERATIONS = 0.01, 20


class FraudResult(NamedTuple):
    """Fitted model, the metric report on train and test, and the scored parts."""

    model: LinearModel
    report: DataFrame
    train: DataFrame
    test: DataFrame


def run_fraud(
    df: DataFrame, label: str = "label", keys: list[str] | None = None, solver: str = "lbfgs", scale: bool = False, **params
) -> FraudResult:
    """The job on a table of numeric columns and a 0/1 label.

    ``keys`` identify a row for the split; without them all columns together do. ``solver`` is ``lbfgs`` (library) or ``gd``
    (batch gradient descent; give ``scale=True`` for z-scores fitted on the training part). Training refuses rows with a missing
    value; a test row with one gets a null probability and prediction.
    """
    keys = keys or df.columns
    features = feature_columns(df, label, drop=[k for k in keys if keys != df.columns])
    train, test = hash_split(df, keys, TRAIN_SHARE, SEED)
    if scale:
        stats = moments_map(moments(train, features))
        train, test = zscore(train, features, stats), zscore(test, features, stats)
    if solver == "gd":
        model = fit_logistic_gd(train, features, label, **({"step": STEP, "iterations": ITERATIONS} | params))
        parts = {name: score_logistic(part, model) for name, part in (("train", train), ("test", test))}
    elif solver == "lbfgs":
        fitted = fit_logistic(assemble(train, features), label, **params)
        model = as_linear_model(fitted, features)
        parts = {
            name: _without_unknown(
                fitted.transform(assemble(part, features, handle_invalid="keep"))
                .withColumn("probability", F.get(vector_to_array("probability"), F.lit(1)))
                .drop("features", "rawPrediction")
            )
            for name, part in (("train", train), ("test", test))
        }
    else:
        raise ValueError(f"solver must be lbfgs or gd, not {solver!r}")
    return FraudResult(model, metric_report(parts, label, "prediction", "probability"), parts["train"], parts["test"])


def _without_unknown(scored: DataFrame) -> DataFrame:
    """Rows with a missing feature have no probability and no decision, as with the other solver."""
    known = ~F.isnan("probability")
    return scored.withColumns({c: F.when(known, F.col(c)) for c in ("probability", "prediction")})


def run_fraud_file(spark: SparkSession, path: str, solver: str = "lbfgs", scale: bool = False) -> FraudResult:
    """The job on a file of numbers whose last column is the label."""
    df = read_labelled(spark, path).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return run_fraud(df, solver=solver, scale=scale)
    finally:
        # The report stands on counts of its own; the scored parts read the file again if they are used.
        df.unpersist()
