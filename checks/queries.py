"""One query per operator: ``(spark, folder of the tables) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arborlog.functions.calendar import calendar_parts, parse_timestamp
from arborlog.functions.encode import assemble, category_index, flag_encode, log_label, to_double, unlog_label
from arborlog.functions.geo import great_circle
from arborlog.functions.linear import add_arrays, dot_arrays, scale_array
from arborlog.operators import metrics as M
from arborlog.operators.moments import moments, zscore
from arborlog.operators.prefix import prefix_sums, tie_ranks
from arborlog.operators.quality import Range, drop_nulls, null_profile, range_filter
from arborlog.operators.sampling import hash_split, in_part
from arborlog.operators.splits import best_splits, node_stats
from arborlog.plans import library as L
from arborlog.plans.fraud import run_fraud
from arborlog.plans.logistic import INTERCEPT, LinearModel, fit_logistic_gd, fit_logistic_lbfgs, gradient, score_logistic
from arborlog.plans.search import grid_search, nested_search
from arborlog.plans.tree import fit_tree, score_tree
from arborlog.plans.trips import ARITY, DEPTHS, FEATURES, LABEL, VENDORS, clean_trips, kept_features, run_trips, trip_features
from arborlog.session import new_path
from arborlog.sources.delimited import preview, read_delimited, read_labelled, write_predictions
from checks import views as V

Query = Callable[[SparkSession, str], DataFrame]

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
HOUR_FEATURES = ["vendor_id", "pickup_hour", "passenger_count"]
# Bins enough for every distinct value, so that the binned trees see every midpoint.
ALL_BINS = 64
# The library solver runs to convergence, so that its optimum can be compared.
TIGHT = {"tol": 1e-12}
SCORE_MODEL = LinearModel(("quantity", "discount"), (1.5, -20.0), 0.25)
GD = {"step": 1e-5, "iterations": 20}
RIDGE = 0.01
CARD_GD = {"step": 1e-3, "iterations": 20}


def rounded(df: DataFrame, digits: int, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in cols})


# Sources and sinks


def csv_roundtrip(spark, sf_dir):
    rows = V.table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", "value", "props", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at")
    )
    path = new_path(spark, "events-csv")
    write_predictions(rows, path)
    schema = "event_id bigint, user_id bigint, event_type string, value double, props string, at string"
    return read_delimited(spark, path, schema, drop=["user_id"])


def labelled_scan(spark, sf_dir):
    path = new_path(spark, "cards-csv")
    write_predictions(V.cards(spark, sf_dir), path)
    return rounded(read_labelled(spark, path), 9, "amount", "hour_share")


def csv_reordered(spark, sf_dir):
    """Two files of one folder with their columns in another order."""
    rows = V.table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    path = new_path(spark, "reordered-csv")
    write_predictions(rows.filter("event_id % 2 = 0"), f"{path}/even")
    write_predictions(rows.filter("event_id % 2 = 1").select("value", "event_type", "event_id"), f"{path}/odd")
    return read_delimited(spark, f"{path}/*", "event_id bigint, event_type string, value double")


def csv_inferred_reordered(spark, sf_dir):
    """Types inferred, columns in another order in each file; whole and broken numbers in one column, and a column that some files lack."""
    rows = V.table(spark, sf_dir, "events").select("event_id", "event_type", "value", F.floor("value").alias("whole"))
    path = new_path(spark, "inferred-csv")
    write_predictions(rows.filter("event_id % 2 = 0").select("event_id", F.col("whole").alias("value"), "event_type"), f"{path}/even")
    write_predictions(rows.filter("event_id % 2 = 1").select("value", "event_type", "event_id", "whole"), f"{path}/odd")
    found = read_delimited(spark, f"{path}/*", infer=True)
    return found.select(F.col("event_id").cast("bigint").alias("event_id"), "event_type", "value", F.col("whole").cast("bigint").alias("whole"))


def csv_repeated_header(spark, sf_dir):
    """Lines equal to the header in the middle of the rows."""
    rows = V.table(spark, sf_dir, "events").select(F.col("event_id").cast("string"), "event_type", "user_id")
    heads = rows.filter("event_id % 100 = 0").select(F.lit("event_id").alias("event_id"), F.lit("event_type").alias("event_type"), F.lit("user_id").alias("user_id"))
    path = new_path(spark, "joined-csv")
    write_predictions(rows.withColumn("user_id", F.col("user_id").cast("string")).unionByName(heads), path)
    return read_delimited(spark, path, "event_id bigint, event_type string, user_id bigint", drop=["user_id"], repeated_header=True)


def cast_double(spark, sf_dir):
    """Text to double; what is no number becomes null."""
    rows = V.table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").cast("string").alias("price"), F.col("o_orderstatus").alias("status"))
    return to_double(rows, ["price", "status"])


def array_steps(spark, sf_dir):
    """A step along the sum of two arrays, as one gradient step on arrays has it."""
    points = V.table(spark, sf_dir, "part").select("p_partkey", F.array(F.col("p_size").cast("double"), F.col("p_retailprice")).alias("a"))
    moved = add_arrays(F.col("a"), scale_array(F.col("a"), -0.5))
    return points.select("p_partkey", F.get(moved, F.lit(0)).alias("m0"), F.get(moved, F.lit(1)).alias("m1"), dot_arrays(F.col("a"), F.col("a")).alias("length2"))


def preview_rows(spark, sf_dir):
    return preview(V.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), "o_orderkey")


def score_table(spark, sf_dir):
    rows = trip_features(V.trips(spark, sf_dir))
    kept = clean_trips(rows)
    model = L.fit_binned_tree(assemble(kept, HOUR_FEATURES), LABEL, max_depth=2, maxBins=ALL_BINS)
    return rounded(L.score_table(rows, model, "id", HOUR_FEATURES, LABEL), 6, LABEL)


# Columns


def trip_columns(spark, sf_dir):
    return rounded(
        trip_features(V.trips(spark, sf_dir)), 6, "distance_km",
        "pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude",
    )


def parsed_times(spark, sf_dir):
    text = F.when(F.col("event_type") == "error", "x").when(
        F.col("event_type") != "view", F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    )
    return parse_timestamp(V.table(spark, sf_dir, "events").select("event_id", text.alias("at")), "at")


def calendar(spark, sf_dir):
    return calendar_parts(V.table(spark, sf_dir, "events").select("event_id", "ts"), "ts", "at").drop("ts")


def flags(spark, sf_dir):
    status = F.nullif(F.col("o_orderstatus"), F.lit("P"))
    return flag_encode(V.table(spark, sf_dir, "orders").select("o_orderkey", status.alias("closed")), "closed", "F")


def distances(spark, sf_dir):
    km = great_circle("lon1", "lat1", F.nullif(F.col("lon2"), F.lit(0.0)), "lat2")
    return rounded(V.customer_points(spark, sf_dir).select("c_custkey", km.alias("km")), 6, "km")


def categories(spark, sf_dir):
    orders = V.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return category_index(orders, "o_orderpriority", PRIORITIES[:4], "priority").drop("o_orderpriority")


def assembled(spark, sf_dir):
    parts = V.table(spark, sf_dir, "part").select(
        "p_partkey", F.nullif(F.col("p_size"), F.lit(7)).alias("size"), "p_retailprice"
    )
    cols = ["size", "p_retailprice"]
    arrays = assemble(parts, cols, "a", as_array=True, handle_invalid="keep")
    both = assemble(arrays, cols, "v", handle_invalid="skip").withColumn("v", vector_to_array("v"))
    return both.select(
        "p_partkey", F.get("a", F.lit(0)).alias("a0"), F.get("a", F.lit(1)).alias("a1"),
        F.get("v", F.lit(0)).alias("v0"), F.get("v", F.lit(1)).alias("v1"),
    )


def logged(spark, sf_dir):
    parts = V.table(spark, sf_dir, "part").select("p_partkey", log_label("p_retailprice").alias("logged"))
    return rounded(parts.withColumn("back", unlog_label("logged")), 6, "logged", "back")


def standardised(spark, sf_dir):
    parts = V.table(spark, sf_dir, "part").select("p_partkey", F.col("p_size").cast("double"), "p_retailprice")
    train, _ = hash_split(parts, "p_partkey")
    cols = ["p_size", "p_retailprice"]
    return rounded(zscore(parts, cols, moments(train, cols)), 6, *cols)


def linear_scores(spark, sf_dir):
    scored = score_logistic(V.returns(spark, sf_dir), SCORE_MODEL)
    return rounded(scored, 9, "probability").groupBy("probability", "prediction").agg(F.count("*").alias("n"))


# Rows


def _with_gaps(spark, sf_dir):
    return V.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.nullif(F.col("l_quantity"), F.lit(13.0)).alias("quantity"),
        F.nullif(F.col("l_discount"), F.lit(0.05)).alias("discount"),
        F.nullif(F.col("l_linestatus"), F.lit("F")).alias("status"),
        "l_extendedprice",
    )


def kept_ranges(spark, sf_dir):
    rules = [Range("quantity", 5, 40, "both"), Range("discount", 0.0, 0.08, "neither"), ("l_extendedprice", 5e3, 9e4, "left")]
    return range_filter(_with_gaps(spark, sf_dir), rules).drop("status")


def nulls(spark, sf_dir):
    return null_profile(_with_gaps(spark, sf_dir))


def without_nulls(spark, sf_dir):
    kept = drop_nulls(_with_gaps(spark, sf_dir), ["quantity", "discount", "status"])
    return kept.groupBy("status", "quantity").agg(F.count("*").alias("n"))


def split_rows(spark, sf_dir):
    train, test = hash_split(V.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber"), "l_orderkey")
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return both.groupBy("part", "l_linenumber").agg(F.count("*").alias("n"), F.sum("l_orderkey").alias("keys"))


# Joins, aggregates, running sums


def joined(spark, sf_dir):
    orders = V.order_guesses(spark, sf_dir)
    return M.join_predictions(
        orders.select("o_orderkey", "prediction"), orders.select("o_orderkey", "label"), "o_orderkey"
    )


def joined_skewed(spark, sf_dir):
    """A third of the predictions are for one id."""
    orders = V.order_guesses(spark, sf_dir)
    key = F.when(F.col("o_orderkey") % 3 == 0, F.lit(1).cast("bigint")).otherwise(F.col("o_orderkey"))
    predictions = orders.select(key.alias("id"), F.col("o_orderkey").alias("row"), "prediction")
    return M.join_skewed(predictions, orders.select(F.col("o_orderkey").alias("id"), "label"), "id")


def joined_metrics(spark, sf_dir):
    orders = V.order_guesses(spark, sf_dir)
    found = M.joined_regression_metrics(
        orders.select("o_custkey", "prediction"), orders.select("o_custkey", "label"), "o_custkey", "label", "prediction"
    )
    return rounded(rounded(found, 4, "rmse"), 9, "r2")


def confusion_counts(spark, sf_dir):
    return M.confusion(V.returns(spark, sf_dir), "returned", "guess")


def class_shares(spark, sf_dir):
    return rounded(M.class_metrics(V.returns(spark, sf_dir), "returned", "guess"), 9, "value")


def regression_quality(spark, sf_dir):
    found = M.regression_metrics(V.order_guesses(spark, sf_dir), "label", "prediction")
    return rounded(rounded(found, 4, "rmse"), 9, "r2")


def column_moments(spark, sf_dir):
    rows = V.table(spark, sf_dir, "lineitem").withColumn("same", F.lit(5.0))
    return rounded(moments(rows, ["l_quantity", "l_extendedprice", "l_discount", "same"]), 6, "mean", "std")


def ranks(spark, sf_dir):
    return tie_ranks(V.table(spark, sf_dir, "events"), "value", buckets=16)


def running_totals(spark, sf_dir):
    rows = V.table(spark, sf_dir, "lineitem")
    return prefix_sums(
        rows, "l_extendedprice", {"n": F.lit(1), "lines": F.col("l_linenumber")}, ["l_returnflag"], buckets=16
    )


def rank_auc(spark, sf_dir):
    return rounded(M.auc_rank(V.returns(spark, sf_dir), "returned", "score"), 9, "auc")


def rank_auc_bucketed(spark, sf_dir):
    return rounded(M.auc_rank(V.returns(spark, sf_dir), "returned", "score", buckets=32), 9, "auc")


def library_auc(spark, sf_dir):
    area = L.binned_auc(V.returns(spark, sf_dir), "returned", "score", bins=0)
    return V.table(spark, sf_dir, "lineitem").agg(F.round(F.lit(area), 9).alias("auc"), F.count("*").alias("n"))


def roc_points(spark, sf_dir):
    return rounded(M.roc_curve(V.returns(spark, sf_dir), "returned", "score"), 9, "tpr", "fpr")


def binned_area(spark, sf_dir):
    return rounded(M.curve_area(M.roc_curve(V.returns(spark, sf_dir), "returned", "score")), 9, "auc")


def report(spark, sf_dir):
    train, test = hash_split(V.returns(spark, sf_dir), "l_orderkey")
    return rounded(M.metric_report({"train": train, "test": test}, "returned", "guess", "score"), 9, "value")


def delta(spark, sf_dir):
    orders = V.order_guesses(spark, sf_dir)
    guess = M.as_metric_rows(M.regression_metrics(orders, "label", "prediction"))
    flat = orders.withColumn("prediction", F.lit(2.5e5))
    baseline = M.as_metric_rows(M.regression_metrics(flat, "label", "prediction"))
    return rounded(M.metric_delta(guess, baseline), 4, "value", "baseline", "delta")


# Trees


def level_stats(spark, sf_dir):
    rows = V.prices(spark, sf_dir).withColumn("node", F.when(F.col("l_linenumber") <= 3, 2).otherwise(3).cast("bigint"))
    found = node_stats(rows, "cents", "node")
    return rounded(rounded(found, 4, "mean"), 0, "variance").withColumn("total", F.col("total").cast("bigint"))


def _two_nodes(spark, sf_dir):
    return V.prices(spark, sf_dir).withColumn("node", F.when(F.col("l_linenumber") <= 3, 2).otherwise(3))


def splits(spark, sf_dir):
    return rounded(best_splits(_two_nodes(spark, sf_dir), V.PRICE_FEATURES, "cents", "node"), 2, "gain")


def splits_bucketed(spark, sf_dir):
    return rounded(best_splits(_two_nodes(spark, sf_dir), V.PRICE_FEATURES, "cents", "node", buckets=16), 2, "gain")


def _price_tree(spark, sf_dir):
    return fit_tree(V.prices(spark, sf_dir), V.PRICE_FEATURES, "cents", max_depth=2)


def exact_tree(spark, sf_dir):
    return rounded(rounded(_price_tree(spark, sf_dir).table(spark), 2, "gain"), 4, "prediction")


def exact_tree_documents(spark, sf_dir):
    model = fit_tree(V.documents(spark, sf_dir), V.DOC_FEATURES, "n_chars", max_depth=4)
    return rounded(rounded(model.table(spark), 2, "gain"), 4, "prediction")


def _log_tree(spark, sf_dir, **params):
    docs = V.documents(spark, sf_dir).withColumn("y", log_label(F.floor(F.col("n_chars") / 500)))
    model = fit_tree(docs, V.DOC_FEATURES, "y", max_depth=5, **params)
    return rounded(rounded(model.table(spark), 9, "gain"), 9, "prediction")


def exact_tree_log(spark, sf_dir):
    return _log_tree(spark, sf_dir)


def exact_tree_cells(spark, sf_dir):
    return _log_tree(spark, sf_dir, buckets=16, local_values=0)


def exact_tree_deep(spark, sf_dir):
    model = fit_tree(V.documents(spark, sf_dir), V.DOC_FEATURES, "n_chars", max_depth=10)
    return rounded(rounded(model.table(spark), 3, "gain"), 4, "prediction")


def exact_tree_categorical(spark, sf_dir):
    rows = category_index(clean_trips(kept_features(V.trips(spark, sf_dir))), "vendor_id", VENDORS)
    model = fit_tree(rows, FEATURES, LABEL, max_depth=10, arity=ARITY)
    # Gains of small nodes are short fractions, which two engines round apart at a half; by this formula they agree.
    gain = F.floor(F.col("gain") * 1000 + 0.5) / 1000
    return rounded(rounded(model.table(spark).withColumn("gain", gain), 4, "prediction"), 9, "threshold")


def tree_scores(spark, sf_dir):
    scored = score_tree(V.prices(spark, sf_dir), _price_tree(spark, sf_dir))
    by_leaf = scored.groupBy("prediction").agg(F.count("*").alias("n"), F.sum("cents").alias("cents"))
    return rounded(by_leaf, 4, "prediction")


def tree_scores_with_nulls(spark, sf_dir):
    """Rows whose quantity or tax is missing; a missing value goes right."""
    prices = V.prices(spark, sf_dir)
    gaps = prices.withColumns({c: F.when(F.col("cents") % k != 0, F.col(c)) for c, k in (("l_quantity", 3), ("l_tax", 5))})
    scored = score_tree(gaps, _price_tree(spark, sf_dir))
    by_leaf = scored.groupBy("prediction").agg(F.count("*").alias("n"), F.sum("cents").alias("cents"))
    return rounded(by_leaf, 4, "prediction")


def tree_rules(spark, sf_dir):
    return _price_tree(spark, sf_dir).rules(spark).drop("position")


def importance(spark, sf_dir):
    return rounded(_price_tree(spark, sf_dir).importance(spark), 9, "importance")


def _leaf_table(spark, rows, model):
    by_leaf = model.transform(rows).groupBy("prediction").agg(F.count("*").alias("n"))
    return rounded(by_leaf, 4, "prediction")


def binned_tree(spark, sf_dir):
    rows = assemble(V.prices(spark, sf_dir), V.PRICE_FEATURES)
    return _leaf_table(spark, rows, L.fit_binned_tree(rows, "cents", max_depth=2, maxBins=ALL_BINS))


def categorical_tree(spark, sf_dir):
    prices = V.prices(spark, sf_dir).withColumn("shifted", F.col("l_linenumber") - 1)
    prices = L.with_arity(prices, {"shifted": 7})
    rows = assemble(prices, ["shifted", "l_discount"])
    return _leaf_table(spark, rows, L.fit_binned_tree(rows, "cents", max_depth=1, maxBins=ALL_BINS))


def _search(spark, sf_dir, features, depths):
    rows = assemble(clean_trips(kept_features(V.trips(spark, sf_dir))), features)
    train, validation = hash_split(rows.select("id", "features", LABEL), "id")
    found = grid_search(
        train,
        validation,
        [{"max_depth": d} for d in depths],
        lambda part, max_depth: L.fit_binned_tree(part, LABEL, max_depth=max_depth, maxBins=ALL_BINS),
        LABEL,
    )
    return rounded(found.table, 6, "value")


def depth_search(spark, sf_dir):
    return _search(spark, sf_dir, FEATURES, [5, 10, 14])


def depth_search_shallow(spark, sf_dir):
    return _search(spark, sf_dir, HOUR_FEATURES, [1, 2, 3])


def depth_search_nested(spark, sf_dir):
    rows = clean_trips(kept_features(V.trips(spark, sf_dir)))
    found = nested_search(*hash_split(rows, "id"), FEATURES, LABEL, DEPTHS)
    return rounded(found.table, 6, "value")


def _library_tree(spark, sf_dir):
    rows = assemble(V.prices(spark, sf_dir), V.PRICE_FEATURES)
    return L.as_tree_model(spark, L.fit_binned_tree(rows, "cents", max_depth=2, maxBins=ALL_BINS), V.PRICE_FEATURES)


def library_rules(spark, sf_dir):
    """The rules of a library tree with a bin for every midpoint, from its node table."""
    return _library_tree(spark, sf_dir).rules(spark).drop("position")


def library_nodes(spark, sf_dir):
    return rounded(rounded(rounded(_library_tree(spark, sf_dir).table(spark), -3, "gain"), 4, "prediction"), 9, "threshold")


def trip_nulls(spark, sf_dir):
    """The null profile that the trip job returns, of trips with gaps."""
    trips = V.trips(spark, sf_dir).withColumns({"passenger_count": F.nullif("passenger_count", F.lit(3)), "pickup_longitude": F.when(F.col("id") % 5 != 0, F.col("pickup_longitude"))})
    return run_trips(trips, kind="exact", max_depth=1).nulls


def trip_delta(spark, sf_dir):
    """The categorical job next to stored metrics."""
    stored = spark.createDataFrame([("rmse", 389.25328786776396), ("r2", 0.672272085049675)], "metric string, value double")
    found = run_trips(V.trips(spark, sf_dir), kind="exact", max_depth=5, baseline=stored).delta
    return rounded(found, 6, "value", "delta")


# Logistic regression


def gradient_step(spark, sf_dir):
    found = gradient(V.returns(spark, sf_dir), ["quantity", "discount"], "returned", [0.1, -0.2, 0.05])
    return rounded(found, 6, "g")


def descent_terms(spark, sf_dir):
    return rounded(fit_logistic_gd(V.returns(spark, sf_dir), ["quantity", "discount"], "returned", **GD).terms(spark), 9, "value")


def descent_quality(spark, sf_dir):
    rows = V.returns(spark, sf_dir)
    scored = score_logistic(rows, fit_logistic_gd(rows, ["quantity", "discount"], "returned", **GD))
    return rounded(M.auc_rank(scored, "returned", "probability"), 9, "auc")


def library_terms(spark, sf_dir):
    model = L.fit_logistic(assemble(V.cards(spark, sf_dir), V.CARD_FEATURES), "label", **TIGHT)
    return rounded(L.as_linear_model(model, V.CARD_FEATURES).terms(spark), 4, "value")


def _vectors(spark, sf_dir):
    return V.table(spark, sf_dir, "embeddings").select(
        F.col("embedding").cast("array<double>").alias("e"), F.when(F.col("label") == 0, 1.0).otherwise(0.0).alias("y")
    )


def wide_library_terms(spark, sf_dir):
    names = [f"e{i}" for i in range(64)]
    rows = assemble(_vectors(spark, sf_dir).select("y", *[F.get("e", F.lit(i)).alias(n) for i, n in enumerate(names)]), names)
    return rounded(L.as_linear_model(L.fit_logistic(rows, "y", regParam=RIDGE), names).terms(spark), 4, "value")


def lbfgs_wide(spark, sf_dir):
    """The penalised gradient at the fitted terms: zero at the optimum."""
    rows = _vectors(spark, sf_dir)
    model = fit_logistic_lbfgs(rows, "e", "y", penalty=RIDGE, standardize=False)
    own = model.terms(spark).withColumn("pull", F.when(F.col("term") != INTERCEPT, F.col("value") * RIDGE).otherwise(0.0))
    mean = gradient(rows, "e", "y", [*model.coefficients, model.intercept]).withColumn("g", F.col("g") / rows.count())
    # Adding 0 turns a negative zero into zero.
    return mean.join(own, "term").select("term", (F.round(F.col("g") + F.col("pull"), 6) + 0.0).alias("g"))


def lbfgs_terms(spark, sf_dir):
    return rounded(fit_logistic_lbfgs(V.cards(spark, sf_dir), V.CARD_FEATURES, "label").terms(spark), 4, "value")


def wide_gradient(spark, sf_dir):
    """256 features: the 64 numbers of a vector and three shifted copies."""
    rows = _vectors(spark, sf_dir)

    def shifted(by):
        return F.transform("e", lambda x: x - by)

    copies = [shifted(k) for k in (0.0, 0.125, 0.25, 0.5)]
    return rounded(gradient(rows.select("y", F.concat(*copies).alias("e")), "e", "y", [0.0] * 257), 6, "g")


# Whole jobs


def trip_job_exact(spark, sf_dir):
    return rounded(run_trips(V.trips(spark, sf_dir), kind="exact").metrics, 6, "value")


def trip_job_binned(spark, sf_dir):
    return rounded(run_trips(V.trips(spark, sf_dir), kind="binned").metrics, 6, "value")


def trip_job_categorical(spark, sf_dir):
    return rounded(run_trips(V.trips(spark, sf_dir), kind="categorical").metrics, 6, "value")


def trip_job_predictions(spark, sf_dir):
    """Training trips filtered, test trips not: every trip gets a prediction."""
    trips = V.trips(spark, sf_dir)
    predictions = run_trips(trips, trips.drop(LABEL), "exact").predictions
    path = new_path(spark, "trip-predictions")
    write_predictions(predictions, path)
    return rounded(read_delimited(spark, path, "id bigint, trip_duration double"), 4, "trip_duration")


def fraud_job_descent(spark, sf_dir):
    found = run_fraud(V.cards(spark, sf_dir), keys=["event_id"], solver="gd", scale=True, **CARD_GD)
    return rounded(found.report, 9, "value")


def fraud_job_library(spark, sf_dir):
    found = run_fraud(V.cards(spark, sf_dir), keys=["event_id"], solver="lbfgs", **TIGHT)
    return rounded(found.report, 4, "value")


def rare_split(spark, sf_dir):
    rare = in_part(["l_orderkey"], 0.0004).alias("rare")
    return V.table(spark, sf_dir, "lineitem").groupBy("l_linenumber", rare).agg(F.count("*").alias("n"))


QUERIES: dict[str, Query] = {
    "tree_exact_log": exact_tree_log,
    "tree_exact_cells": exact_tree_cells,
    "tree_exact_deep": exact_tree_deep,
    "tree_exact_categorical": exact_tree_categorical,
    "depth_search_nested": depth_search_nested,
    "rare_split": rare_split,
    "tree_score_nulls": tree_scores_with_nulls,
    "csv_reordered": csv_reordered,
    "csv_inferred_reordered": csv_inferred_reordered,
    "roc_curve": roc_points,
    "auc_binned": binned_area,
    "csv_repeated_header": csv_repeated_header,
    "cast_double": cast_double,
    "array_steps": array_steps,
    "csv_roundtrip": csv_roundtrip,
    "labelled_scan": labelled_scan,
    "preview_rows": preview_rows,
    "score_table": score_table,
    "trip_features": trip_columns,
    "parse_timestamp": parsed_times,
    "calendar_parts": calendar,
    "flag_encode": flags,
    "great_circle": distances,
    "category_index": categories,
    "assemble_features": assembled,
    "log_label": logged,
    "zscore": standardised,
    "linear_score": linear_scores,
    "range_filter": kept_ranges,
    "null_profile": nulls,
    "drop_nulls": without_nulls,
    "hash_split": split_rows,
    "join_predictions": joined,
    "join_predictions_skewed": joined_skewed,
    "joined_metrics": joined_metrics,
    "confusion_counts": confusion_counts,
    "class_metrics": class_shares,
    "regression_metrics": regression_quality,
    "feature_moments": column_moments,
    "tie_ranks": ranks,
    "prefix_sums": running_totals,
    "auc_rank": rank_auc,
    "auc_rank_bucketed": rank_auc_bucketed,
    "auc_scores": library_auc,
    "metric_report": report,
    "metric_delta": delta,
    "node_stats": level_stats,
    "best_split": splits,
    "best_split_bucketed": splits_bucketed,
    "tree_exact": exact_tree,
    "tree_exact_documents": exact_tree_documents,
    "tree_score": tree_scores,
    "tree_rules": tree_rules,
    "feature_importance": importance,
    "tree_binned": binned_tree,
    "tree_categorical": categorical_tree,
    "depth_search": depth_search,
    "depth_search_shallow": depth_search_shallow,
    "library_rules": library_rules,
    "library_nodes": library_nodes,
    "trip_job_nulls": trip_nulls,
    "trip_job_delta": trip_delta,
    "gradient_step": gradient_step,
    "gradient_wide": wide_gradient,
    "logistic_gd": descent_quality,
    "model_terms": descent_terms,
    "logistic_lbfgs": library_terms,
    "lbfgs_terms": lbfgs_terms,
    "lbfgs_wide": lbfgs_wide,
    "logistic_lbfgs_wide": wide_library_terms,
    "trip_job_exact": trip_job_exact,
    "trip_job_binned": trip_job_binned,
    "trip_job_categorical": trip_job_categorical,
    "trip_job_predictions": trip_job_predictions,
    "fraud_job_descent": fraud_job_descent,
    "fraud_job_library": fraud_job_library,
}
