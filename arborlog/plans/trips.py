"""Trip-duration job: read, derive features, filter, split, train a regression tree, measure, predict, write."""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arborlog.functions.calendar import calendar_parts, parse_timestamp
from arborlog.functions.encode import assemble, category_index, flag_encode, log_label, unlog_label
from arborlog.functions.geo import great_circle
from arborlog.operators.metrics import as_metric_rows, metric_delta, regression_metrics
from arborlog.operators.moments import moments, moments_map, zscore
from arborlog.operators.quality import Range, drop_nulls, null_profile, range_filter
from arborlog.operators.sampling import hash_split
from arborlog.plans.library import fit_binned_tree, score_table, tree_importance, tree_text, with_arity
from arborlog.plans.search import grid_search
from arborlog.plans.tree import fit_tree, score_tree
from arborlog.session import written
from arborlog.sources.delimited import read_delimited, write_predictions

# Columns of the trip files, the features in model order, the kept ranges, the category sizes, the searched
# depths, the split.
TEST_SCHEMA = (
    "id string, vendor_id int, pickup_datetime string, passenger_count int, pickup_longitude double, "
    "pickup_latitude double, dropoff_longitude double, dropoff_latitude double, store_and_fwd_flag string"
)
TRAIN_SCHEMA = (
    "id string, vendor_id int, pickup_datetime string, dropoff_datetime string, passenger_count int, "
    "pickup_longitude double, pickup_latitude double, dropoff_longitude double, dropoff_latitude double, "
    "store_and_fwd_flag string, trip_duration int"
)
FEATURES = [
    "vendor_id",
    "pickup_year",
    "pickup_month",
    "pickup_day",
    "pickup_hour",
    "pickup_min",
    "pickup_sec",
    "passenger_count",
    "pickup_longitude",
    "pickup_latitude",
    "dropoff_longitude",
    "dropoff_latitude",
    "store_and_fwd_flag",
    "distance_km",
]
LABEL = "trip_duration"
KEPT = [
    Range("trip_duration", 0, 36000, "neither"),
    Range("passenger_count", 1, 6, "both"),
    Range("distance_km", 0, 100, "neither"),
]
# Columns to test for null. The rest is never null, is null together with one of these, or fails a range when null.
NOT_NULL = [
    "id",
    "vendor_id",
    "pickup_year",
    "pickup_longitude",
    "pickup_latitude",
    "dropoff_longitude",
    "dropoff_latitude",
]
ARITY = {"vendor_id": 2, "passenger_count": 10, "store_and_fwd_flag": 2}
VENDORS = [1, 2]
DEPTHS = [5, 10, 14]
TRAIN_SHARE, SEED = 0.8, 24


class TripResult(NamedTuple):
    """Validation metrics, importances, rules and search table (binned trees only), predictions for the test trips, the nulls of the
    training features before they are filtered, and the metrics next to those of an earlier run, if one is given."""

    metrics: DataFrame
    importance: DataFrame
    rules: DataFrame
    search: DataFrame | None
    predictions: DataFrame | None
    nulls: DataFrame | None = None
    delta: DataFrame | None = None


def trip_features(trips: DataFrame, labelled: bool = True) -> DataFrame:
    """``id``, the 14 features and, if ``labelled``, the duration. The same function serves training and test trips."""
    if isinstance(trips.schema["pickup_datetime"].dataType, T.StringType):
        trips = parse_timestamp(trips, "pickup_datetime")
    trips = flag_encode(calendar_parts(trips, "pickup_datetime", "pickup"), "store_and_fwd_flag")
    km = great_circle("pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude")
    return trips.withColumn("distance_km", km).select("id", *FEATURES, *([LABEL] if labelled else []))


def kept_features(trips: DataFrame, labelled: bool = True) -> DataFrame:
    """``trip_features`` as a table in the shared folder.

    A job reads its features many times. Read from the trips, every pass would work them out again, and the planner would repeat
    their expressions in the filters that follow: a generated method that is too long for the JVM to compile.
    """
    return written(trip_features(trips, labelled), "trip-features")


def clean_trips(features: DataFrame) -> DataFrame:
    """Drop outliers and rows with nulls (training trips only)."""
    return range_filter(drop_nulls(features, NOT_NULL), KEPT)


def run_trips(
    train: DataFrame,
    test: DataFrame | None = None,
    kind: str = "binned",
    max_depth: int | None = None,
    handle_invalid: str = "keep",
    baseline: DataFrame | None = None,
    **params,
) -> TripResult:
    """The job on trip tables. ``kind`` picks the tree:

    ``binned``: library tree, depth searched over 5, 10 and 14 on the validation part, the best model scores the test trips;
    ``categorical``: library tree of depth 10 that splits vendor, passengers and flag by subsets;
    ``exact``: every midpoint is a candidate, depth 5, on z-scored features and log durations.

    Metrics are in seconds in all cases. ``handle_invalid`` says what a missing value in a test trip does, alike for all kinds:
    ``keep`` predicts the trip (a missing value goes right at its split), ``skip`` leaves the trip out, ``error`` raises.
    ``baseline`` holds the metrics of an earlier run (``metric, value``); the result then has the differences.
    """
    features = kept_features(train)
    data = clean_trips(features)
    target = kept_features(test, labelled=False) if test is not None else None
    if kind == "binned":
        result = _library_job(data, target, [max_depth] if max_depth else DEPTHS, handle_invalid, params)
    elif kind == "categorical":
        data, target = (_as_categories(df) if df is not None else None for df in (data, target))
        result = _library_job(data, target, [max_depth or 10], handle_invalid, params)
    elif kind == "exact":
        result = _exact_job(data, target, max_depth or 5, handle_invalid, params)
    else:
        raise ValueError(f"kind must be binned, categorical or exact, not {kind!r}")
    delta = metric_delta(result.metrics, baseline) if baseline is not None else None
    return result._replace(nulls=null_profile(features), delta=delta)


def _as_categories(df: DataFrame) -> DataFrame:
    df = category_index(df, "vendor_id", VENDORS)
    return with_arity(df, {c: k for c, k in ARITY.items() if c != "vendor_id"})


def _library_job(data: DataFrame, target: DataFrame | None, depths: list[int], handle_invalid: str, params: dict) -> TripResult:
    spark = data.sparkSession
    rows = assemble(data, FEATURES).select("id", "features", LABEL)
    train, validation = hash_split(rows, "id", TRAIN_SHARE, SEED)
    found = grid_search(
        train,
        validation,
        [{"max_depth": d} for d in depths],
        lambda part, max_depth: fit_binned_tree(part, LABEL, max_depth=max_depth, seed=SEED, **params),
        LABEL,
    )
    return TripResult(
        as_metric_rows(regression_metrics(found.model.transform(validation), LABEL, "prediction")),
        tree_importance(spark, found.model, FEATURES),
        tree_text(spark, found.model),
        found.table,
        None if target is None else score_table(target, found.model, "id", FEATURES, LABEL, handle_invalid),
    )


def _exact_job(data: DataFrame, target: DataFrame | None, max_depth: int, handle_invalid: str, params: dict) -> TripResult:
    spark = data.sparkSession
    train, validation = hash_split(data, "id", TRAIN_SHARE, SEED)
    stats = moments_map(moments(train, FEATURES))
    logged = zscore(train, FEATURES, stats).withColumn("log_duration", log_label(F.col(LABEL)))
    model = fit_tree(logged, FEATURES, "log_duration", max_depth, **params)

    if target is not None:
        target = assemble(target, FEATURES, "_values", as_array=True, handle_invalid=handle_invalid)
        # The array is read by a test that is always true, so that its check for nulls is made.
        target = target.filter(F.size("_values") > 0).drop("_values")

    def predict(df: DataFrame) -> DataFrame:
        return score_tree(zscore(df, FEATURES, stats), model, inverse=unlog_label)

    return TripResult(
        as_metric_rows(regression_metrics(predict(validation), LABEL, "prediction")),
        model.importance(spark),
        model.rules(spark, inverse=math.expm1),
        None,
        None if target is None else predict(target).select("id", F.col("prediction").alias(LABEL)),
    )


def run_trip_files(
    spark: SparkSession,
    train_path: str,
    test_path: str,
    output_path: str,
    kind: str = "binned",
    single_file: bool = False,
    handle_invalid: str = "keep",
) -> TripResult:
    """The job on files with the trip columns; writes ``id, trip_duration`` for the test trips."""
    train = read_delimited(spark, train_path, TRAIN_SCHEMA, drop=["dropoff_datetime"]).persist(
        StorageLevel.MEMORY_AND_DISK
    )
    try:
        result = run_trips(train, read_delimited(spark, test_path, TEST_SCHEMA), kind, handle_invalid=handle_invalid)
        write_predictions(result.predictions, output_path, single_file)
        return result
    finally:
        train.unpersist()
