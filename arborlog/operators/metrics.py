"""Quality of predictions, as tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arborlog.operators.prefix import prefix_sums
from arborlog.session import reliable_checkpoint


def join_predictions(predictions: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """Pair predictions with labels by an id. Inner join: an id that repeats on both sides gives every pair.

    Where the label can be carried through scoring, no join is needed; for metrics over ids that repeat use
    ``joined_regression_metrics``, which makes no pairs.
    """
    return predictions.join(labels, key, "inner")


# So many rows are put in order by one task.
FEW_ROWS = 10_000
# A key is hot if it has more than this part of a side's rows, so a side has fewer hot keys than that.
HOT_PART = 64
# Rows of a key that is hot on one side are dealt to so many tasks; of one that is hot on both, to the square of it.
GRID = 16


def join_skewed(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """``left.join(right, key)`` for keys that may hold a large part of the rows, whatever the planner does about skew.

    Both sides are counted by key first. Rows of hot keys are numbered, kept in the shared folder (so that a task that runs again
    deals them as before) and dealt to a grid: a side that is hot is split, and its counterpart is repeated for each part.
    All other rows take the plain join. Rows without a key have no partner.
    """

    def hot(side: DataFrame) -> set:
        counts = side.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
        least = side.count() // HOT_PART
        return {r[key] for r in counts.filter(F.col("_n") > max(1, least)).orderBy(F.desc("_n")).limit(HOT_PART).collect()} if least else set()

    hot_left, hot_right = hot(left), hot(right)
    both = sorted(hot_left | hot_right)
    if not both:
        return left.join(right, key)
    is_hot = F.col(key).isin(*both)
    plain = left.filter(~is_hot).join(right.filter(~is_hot), key)

    def dealt(side: DataFrame, own: set, other: set, mine: str, others: str) -> DataFrame:
        kept = reliable_checkpoint(side.filter(is_hot).withColumn("_number", F.monotonically_increasing_id()))
        split = F.when(F.col(key).isin(*own), F.pmod(F.xxhash64("_number"), F.lit(GRID))).otherwise(0) if own else F.lit(0).cast("bigint")
        every = F.sequence(F.lit(0).cast("bigint"), F.lit(GRID - 1).cast("bigint"))
        one = F.array(F.lit(0).cast("bigint"))
        repeated = F.when(F.col(key).isin(*other), every).otherwise(one) if other else one
        return kept.withColumn(mine, split.cast("bigint")).withColumn(others, F.explode(repeated)).drop("_number")

    grid = dealt(left, hot_left, hot_right, "_row", "_column").join(dealt(right, hot_right, hot_left, "_column", "_row"), [key, "_row", "_column"])
    return plain.unionByName(grid.drop("_row", "_column"))


def confusion(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """``label, prediction, n``: row counts of each combination."""
    return df.groupBy(*by, F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count("*").alias("n")
    )


def _share(part: Column, whole: Column) -> Column:
    return F.coalesce(part / F.nullif(whole, F.lit(0)), F.lit(0.0))


def class_metrics(
    df: DataFrame, label: str, prediction: str, labels: Sequence[float] = (0, 1), by: Sequence[str] = ()
) -> DataFrame:
    """``metric, label, value``: accuracy, and precision and recall of each of ``labels``.

    A share of nothing is 0.0: precision of a label never predicted, recall of a label never present.
    """
    return _shares(confusion(df, label, prediction, by), labels, by)


def _shares(counts: DataFrame, labels: Sequence[float], by: Sequence[str]) -> DataFrame:
    """``class_metrics`` of a table of counts (``label, prediction, n``)."""
    n, is_label, is_predicted = F.col("n"), F.col("label"), F.col("prediction")

    def rows_where(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, n)), F.lit(0))

    totals = [F.coalesce(F.sum(n), F.lit(0)).alias("total"), rows_where(is_label == is_predicted).alias("correct")]
    for i, value in enumerate(labels):
        totals += [
            rows_where((is_label == value) & (is_predicted == value)).alias(f"hit{i}"),
            rows_where(is_predicted == value).alias(f"predicted{i}"),
            rows_where(is_label == value).alias(f"present{i}"),
        ]

    def row(metric: str, value: float | None, share: Column) -> Column:
        return F.struct(
            F.lit(metric).alias("metric"), F.lit(value).cast("double").alias("label"), share.alias("value")
        )

    rows = [row("accuracy", None, _share(F.col("correct"), F.col("total")))]
    for i, value in enumerate(labels):
        rows.append(row("precision", value, _share(F.col(f"hit{i}"), F.col(f"predicted{i}"))))
        rows.append(row("recall", value, _share(F.col(f"hit{i}"), F.col(f"present{i}"))))
    return counts.groupBy(*by).agg(*totals).select(*by, F.inline(F.array(*rows)))


def auc_rank(
    df: DataFrame,
    label: str,
    score: str,
    by: Sequence[str] = (),
    buckets: int | None = None,
    weight: str | None = None,
) -> DataFrame:
    """``auc``: chance that a random positive has a higher score than a random negative, ties counting half.

    Equals the rank-sum form with average ranks. The negatives below each score are counted directly, which takes no
    difference of large numbers. 0.0 when a class is missing. Rows whose score is null or NaN have no place in the order and are
    left out, as ``regression_metrics`` leaves them out. Give hard 0/1 predictions as the score for the AUC of a
    classifier at its threshold, or a probability for the AUC of the model. ``weight`` names a column of row counts, for a
    table that is already added up.
    """
    rows = F.col(weight) if weight else F.lit(1)
    df = df.filter(F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")))
    positive = F.when(F.col(label) == 1, rows).otherwise(0)
    negative = F.when(F.col(label) == 0, rows).otherwise(0)
    ranked = prefix_sums(df, score, {"pos": positive, "neg": negative}, by, buckets)
    below = F.col("cum_neg") - F.col("neg") / 2.0
    won = F.sum(F.col("pos") * below)
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return ranked.groupBy(*by).agg(F.coalesce(won / F.nullif(pairs, F.lit(0.0)), F.lit(0.0)).alias("auc"))


def roc_curve(df: DataFrame, label: str, score: str, bins: int = 1000) -> DataFrame:
    """``threshold, tpr, fpr``: shares of the positives and of the negatives with a score at or above each threshold.

    The distinct scores, highest first, are taken together in groups of ``n // bins`` neighbours, and each group is a point at its lowest
    score; with fewer than ``2 * bins`` distinct scores, or ``bins=0``, every score is a point. So the points depend on no partition. A
    share of nothing is 0.0; null and NaN scores are left out, as in ``auc_rank``. The counts per score are kept in the shared folder.
    """
    known = df.filter(F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")))
    positive, negative = (F.sum(F.when(F.col(label) == k, 1).otherwise(0)) for k in (1, 0))
    counts = reliable_checkpoint(known.groupBy(F.col(score).alias("score")).agg(positive.alias("pos"), negative.alias("neg")))
    whole = counts.agg(F.count("*").alias("n"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).first()
    group = max(1, whole["n"] // bins) if bins else 1
    ranked = prefix_sums(counts, "score", {"pos": F.col("pos"), "neg": F.col("neg"), "one": F.lit(1)}, kept=True)
    point = F.floor((F.lit(whole["n"]) - F.col("cum_one")) / group)
    below = ranked.groupBy(point.alias("point")).agg(
        F.min("score").alias("threshold"), F.min(F.col("cum_pos") - F.col("pos")).alias("pos"), F.min(F.col("cum_neg") - F.col("neg")).alias("neg")
    )

    def share(part: str) -> Column:
        return F.lit((whole[part] or 0) - F.col(part)) / float(whole[part]) if whole[part] else F.lit(0.0)

    return below.select("threshold", share("pos").alias("tpr"), share("neg").alias("fpr"))


def curve_area(points: DataFrame) -> DataFrame:
    """``auc``: the area under the points of a ``roc_curve`` by trapezoids, from (0, 0) to (1, 1).

    One task puts the points in order, so the curve must be binned; ``auc_rank`` gives the area over all scores.
    """
    in_order = Window.orderBy(F.desc("threshold"))
    before_x, before_y = (F.coalesce(F.lag(c).over(in_order), F.lit(0.0)) for c in ("fpr", "tpr"))
    parts = points.select(((F.col("fpr") - before_x) * (F.col("tpr") + before_y) / 2).alias("part"), "fpr", "tpr")
    rest = (1 - F.max("fpr")) * (1 + F.max("tpr")) / 2
    return parts.agg(F.coalesce(F.sum("part") + rest, F.lit(0.0)).alias("auc"))


def regression_metrics(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """``n, rmse, r2`` over rows that have both values, in one pass; r2 is 0.0 for a constant label."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    both = y.isNotNull() & p.isNotNull()
    return (
        df.select(*by, F.when(both, y).alias("y"), F.when(both, p).alias("p"))
        .groupBy(*by)
        .agg(
            F.count("y").alias("n"),
            F.avg(F.pow(F.col("p") - F.col("y"), 2)).alias("mse"),
            F.var_pop("y").alias("spread"),
        )
        .select(*by, "n", *_rmse_r2())
    )


def _rmse_r2() -> list[Column]:
    mse, spread = F.col("mse"), F.col("spread")
    return [F.sqrt(mse).alias("rmse"), F.coalesce(1 - mse / F.nullif(spread, F.lit(0.0)), F.lit(0.0)).alias("r2")]


def joined_regression_metrics(
    predictions: DataFrame, labels: DataFrame, key: str, label: str, prediction: str
) -> DataFrame:
    """``regression_metrics`` of the joined pairs, without making the pairs.

    Each side is first reduced to count, mean and variance per id, so an id that holds a large part of both sides stays one
    row in the join. Over the pairs of an id, Σ(p − y)² = n_p · n_y · ((mean p − mean y)² + var p + var y). The spread of
    the labels is taken over the label table, as the metric of unjoined labels.
    """

    def per_id(df: DataFrame, value: str, tag: str) -> DataFrame:
        v = F.col(value).cast("double")
        return (
            df.filter(F.col(key).isNotNull() & v.isNotNull())
            .groupBy(key)
            .agg(F.count("*").alias(f"n_{tag}"), F.avg(v).alias(f"mean_{tag}"), F.var_pop(v).alias(f"var_{tag}"))
        )

    pairs = F.col("n_p").cast("double") * F.col("n_y")
    gap = F.pow(F.col("mean_p") - F.col("mean_y"), 2) + F.col("var_p") + F.col("var_y")
    joined = (
        per_id(predictions, prediction, "p")
        .join(per_id(labels, label, "y"), key)
        .agg(F.coalesce(F.sum(F.col("n_p") * F.col("n_y")), F.lit(0)).alias("n"), F.sum(pairs * gap).alias("ss_res"))
    )
    y = F.col(label).cast("double")
    spread = labels.agg((F.var_pop(y) * F.count(y)).alias("ss_tot"))
    # Two one-row tables, stacked and folded into one row.
    both = joined.unionByName(spread, allowMissingColumns=True).agg(*[F.max(c).alias(c) for c in ("n", "ss_res", "ss_tot")])
    return both.select(
        "n",
        F.sqrt(F.col("ss_res") / F.nullif(F.col("n"), F.lit(0))).alias("rmse"),
        F.coalesce(1 - F.col("ss_res") / F.nullif(F.col("ss_tot"), F.lit(0.0)), F.lit(0.0)).alias("r2"),
    )


def as_metric_rows(df: DataFrame, metrics: Sequence[str] = ("rmse", "r2")) -> DataFrame:
    """Turn one wide row of metrics into ``metric, value`` rows."""
    rows = [F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics]
    return df.select(F.inline(F.array(*rows)))


def metric_report(
    parts: Mapping[str, DataFrame], label: str, prediction: str, score: str | None = None, labels: Sequence[float] = (0, 1)
) -> DataFrame:
    """``split, metric, label, value`` for named parts such as train and test.

    Holds accuracy, precision and recall per label, ``auc_hard`` (AUC of the hard predictions) and, with a ``score``
    column, ``auc`` (AUC of the scores). Every part is read once: its counts by label, prediction and score are kept in the
    shared folder, and all metrics come from them.
    """
    columns = {"label": F.col(label), "prediction": F.col(prediction)} | ({"score": F.col(score)} if score else {})
    stacked = reduce(
        DataFrame.unionByName,
        [
            df.select(F.lit(name).alias("split"), *[c.alias(n) for n, c in columns.items()])
            for name, df in parts.items()
        ],
    )
    kept = reliable_checkpoint(stacked.groupBy("split", *columns).agg(F.count("*").alias("n")))
    counts = kept.groupBy("split", "label", "prediction").agg(F.sum("n").alias("n"))
    report = _shares(counts, labels, ["split"])
    # Hard predictions have few values, which one window per part puts in order; if they are scores after all, they take buckets.
    few = counts.count() <= FEW_ROWS
    curves = {"auc_hard": auc_rank(counts, "label", "prediction", by=["split"], weight="n", buckets=1 if few else None)}
    if score:
        curves["auc"] = auc_rank(kept, "label", "score", by=["split"], weight="n")
    for name, curve in curves.items():
        report = report.unionByName(
            curve.select(
                "split", F.lit(name).alias("metric"), F.lit(None).cast("double").alias("label"), F.col("auc").alias("value")
            )
        )
    return report


def metric_delta(metrics: DataFrame, baseline: DataFrame) -> DataFrame:
    """``metric, value, baseline, delta`` against stored values (``metric, value``) of an earlier run."""
    earlier = baseline.select("metric", F.col("value").alias("baseline"))
    return metrics.select("metric", "value").join(earlier, "metric").withColumn(
        "delta", F.col("value") - F.col("baseline")
    )
