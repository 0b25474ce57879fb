"""Models of Spark ML with the settings of the jobs, and their results as tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arborlog.functions.encode import assemble, nominal
from arborlog.plans.logistic import LinearModel
from arborlog.plans.tree import TreeModel, TreeNode
from arborlog.session import local_table, new_path

_RULE = pa.schema([("position", pa.int32()), ("rule", pa.string())])
_IMPORTANCE = pa.schema([("feature", pa.string()), ("importance", pa.float64())])


def fit_binned_tree(
    df: DataFrame, label: str, features: str = "features", max_depth: int = 5, seed: int = 24, **params
) -> DecisionTreeRegressionModel:
    """Regression tree over binned candidates, split search on the executors.

    ``params`` go to ``DecisionTreeRegressor``. Features marked as categorical (``category_index``, ``with_arity``) are split
    by subsets of their values.
    """
    return DecisionTreeRegressor(
        featuresCol=features, labelCol=label, maxDepth=max_depth, impurity="variance", seed=seed, **params
    ).fit(df)


def with_arity(df: DataFrame, arity: Mapping[str, int]) -> DataFrame:
    """Mark columns that already hold 0 … k − 1 as categorical with k values."""
    return df.withColumns({c: nominal(F.col(c).cast("double"), c, range(k)) for c, k in arity.items()})


def as_tree_model(spark: SparkSession, model: DecisionTreeRegressionModel, features: Sequence[str]) -> TreeModel:
    """A library tree as a model table of this library: rules, importances, scores and smaller depths come from the same code.

    The nodes are read from the saved model, which only holds what the tree needs; the saved copy lies in the shared folder.
    """
    path = new_path(spark, "library-tree")
    model.save(path)
    saved = spark.read.parquet(f"{path}/data")
    split = F.col("split")
    rows = saved.select(
        "id", "prediction", "gain", "leftChild", "rightChild", "rawCount",
        split["featureIndex"].alias("feature"), split["leftCategoriesOrThreshold"].alias("left"), split["numCategories"].alias("categories"),
    ).collect()
    by_id = {r["id"]: r for r in rows}
    nodes, categorical, waiting = [], set(), [(1, 0)]
    while waiting:
        node, at = waiting.pop()
        r, depth = by_id[at], node.bit_length() - 1
        n = int(r["rawCount"])
        if r["leftChild"] < 0:
            nodes.append(TreeNode(node, depth, None, None, None, n, r["prediction"]))
            continue
        is_set = r["categories"] >= 0
        subset = sum(1 << int(c) for c in r["left"]) if is_set else None
        if is_set:
            categorical.add(r["feature"])
        nodes.append(TreeNode(node, depth, r["feature"], None if is_set else r["left"][0], r["gain"], n, r["prediction"], subset))
        waiting += [(2 * node, r["leftChild"]), (2 * node + 1, r["rightChild"])]
    return TreeModel(tuple(features), tuple(sorted(nodes, key=lambda n: n.node_id)), tuple(sorted(categorical)))


def tree_importance(spark: SparkSession, model: DecisionTreeRegressionModel, features: Sequence[str]) -> DataFrame:
    """``feature, importance`` of a library tree."""
    return local_table(spark, _IMPORTANCE, list(zip(features, (float(v) for v in model.featureImportances.toArray()))))


def tree_text(spark: SparkSession, model: DecisionTreeRegressionModel) -> DataFrame:
    """``position, rule``: the rule listing of a library tree, one row per line."""
    lines = [line for line in model.toDebugString.splitlines() if line.strip()]
    return local_table(spark, _RULE, list(enumerate(lines)))


def score_table(
    df: DataFrame, model, id_col: str, features: Sequence[str], output: str = "trip_duration", handle_invalid: str = "error"
) -> DataFrame:
    """``id, <output>``: predictions of a library model next to the id they belong to.

    The id stays in the scored rows, so predictions and ids need no pairing afterwards.
    """
    rows = assemble(df.select(id_col, *features), features, handle_invalid=handle_invalid)
    return model.transform(rows).select(id_col, "prediction").withColumnRenamed("prediction", output)


def fit_logistic(
    df: DataFrame, label: str, features: str = "features", max_iter: int = 100, **params
) -> LogisticRegressionModel:
    """Logistic regression with the library solver (L-BFGS), with intercept and without penalty."""
    return LogisticRegression(
        featuresCol=features, labelCol=label, maxIter=max_iter, fitIntercept=True, **params
    ).fit(df)


def as_linear_model(model: LogisticRegressionModel, features: Sequence[str]) -> LinearModel:
    """The coefficients of a fitted library model; ``.terms()`` gives them as a table."""
    return LinearModel(tuple(features), tuple(float(c) for c in model.coefficients), float(model.intercept))


def binned_auc(df: DataFrame, label: str, score: str = "rawPrediction", bins: int = 1000) -> float:
    """Area under the ROC curve by the library evaluator; ``bins=0`` keeps every distinct score."""
    return BinaryClassificationEvaluator(labelCol=label, rawPredictionCol=score, numBins=bins).evaluate(df)
