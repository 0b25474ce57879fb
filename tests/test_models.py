import json
import math

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from arborlog.functions.encode import assemble, log_label, unlog_label
from arborlog.operators.splits import best_splits, cell_bounds, level_splits, node_stats, with_cells
from arborlog.plans import library as L
from arborlog.plans.logistic import LinearModel, fit_logistic_gd, fit_logistic_lbfgs, gradient, score_logistic
from arborlog.plans.search import grid_search, nested_search
from arborlog.plans.tree import TreeModel, categories, fit_tree, score_depths, score_tree
from tests import brute


def table(spark, x, y):
    names = [f"f{i}" for i in range(x.shape[1])]
    rows = [(*map(float, a), v) for a, v in zip(x, y.tolist())]
    kind = "bigint" if np.issubdtype(y.dtype, np.integer) else "double"
    return spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names) + f", y {kind}"), names


def sample(seed=0, n=400, signal=True):
    """Features with few values, a hot value, continuous values, an exact copy; whole-number labels."""
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 6, n)
    b = np.where(rng.random(n) < 0.4, 2.5, rng.normal(3, 2, n))
    c = rng.normal(size=n)
    x = np.c_[a, b, c, a]
    y = rng.integers(0, 100, n) + (np.floor(20 * (b > 3) + 30 * (a == 4)).astype(int) if signal else 0)
    return x, y


def check(model, expected):
    assert {n.node_id for n in model.nodes} == set(expected)
    for n in model.nodes:
        f, cut, rows, mean = expected[n.node_id]
        assert (n.feature, n.n) == (f, rows)
        assert n.threshold == (None if cut is None else pytest.approx(cut))
        assert n.prediction == pytest.approx(mean)


def test_best_split_by_hand(spark):
    x = np.array([[1.0], [2.0], [3.0], [4.0]])
    df, names = table(spark, x, np.array([1, 1, 5, 5]))
    for buckets in (1, 3):
        assert [tuple(r) for r in best_splits(df, names, "y", buckets=buckets).collect()] == [(1, 0, 2.5, 4.0)]
    for x2, y2 in (([[7.0]] * 4, [1, 1, 5, 5]), ([[1.0], [2.0], [3.0], [4.0]], [5, 5, 5, 5])):
        flat, _ = table(spark, np.array(x2), np.array(y2))
        assert best_splits(flat, names, "y").count() == 0
    twice, both = table(spark, np.c_[x, x], np.array([1, 1, 5, 5]))
    assert best_splits(twice, both, "y").first()["feature"] == 0


def test_threshold_between_neighbouring_doubles(spark):
    low = 1.0
    high = math.nextafter(low, 2)
    df, names = table(spark, np.array([[low], [high]]), np.array([1, 5]))
    cut = best_splits(df, names, "y", buckets=1).first()["threshold"]
    assert low <= cut < high


@pytest.mark.parametrize("seed,signal", [(0, True), (1, False), (2, True)])
def test_pruned_search_equals_brute_force(spark, seed, signal):
    x, y = sample(seed, signal=signal)
    df, names = table(spark, x, y)
    gain, f, cut = brute.best_split(x, y)
    rows = df.select(F.lit(1).cast("bigint").alias("node"), "y", *[F.col(n).alias(f"x{i}") for i, n in enumerate(names)])
    for buckets, cell_rows in ((1, 10), (4, 10**6), (16, 10**6), (8, 20)):
        prepared = with_cells(rows, 4, cell_bounds(rows, 4, buckets, None))
        got = level_splits(prepared, 4, lambda c: c.persist(), cell_rows).collect()
        assert len(got) == 1
        assert (got[0]["feature"], got[0]["n"], got[0]["total"]) == (f, len(y), y.sum())
        assert got[0]["threshold"] == pytest.approx(cut) and got[0]["gain"] == pytest.approx(gain)
    spark.catalog.clearCache()


def test_search_without_broadcast(spark, monkeypatch):
    """Beyond the broadcast bound the search takes another way and finds the same."""
    monkeypatch.setattr("arborlog.operators.splits.MAX_BROADCAST_ROWS", 0)
    monkeypatch.setattr("arborlog.session.MAX_BROADCAST_ROWS", 0)
    x, y = sample(5)
    df, names = table(spark, x, y)
    check(fit_tree(df, names, "y", 2, buckets=8, local_values=0), brute.tree(x, y, 2))


def test_node_stats(spark):
    df = spark.createDataFrame([(1, 2), (1, 4), (2, 7)], "k bigint, y bigint")
    got = {r["node"]: tuple(r)[1:] for r in node_stats(df, "y", "k").collect()}
    assert got == {1: (2, 6, 3.0, 1.0, 2, 4), 2: (1, 7, 7.0, 0.0, 7, 7)}


def test_tree_by_hand(spark):
    df, names = table(spark, np.array([[1.0], [2.0], [3.0], [4.0]]), np.array([1, 1, 5, 5]))
    model = fit_tree(df, names, "y", 1)
    assert [(n.node_id, n.n, n.prediction) for n in model.nodes] == [(1, 4, 3.0), (2, 2, 1.0), (3, 2, 5.0)]
    assert len(fit_tree(df, names, "y", 5).nodes) == 3  # pure leaves stop
    assert len(fit_tree(df, names, "y", 0).nodes) == 1
    assert fit_tree(df.filter("y > 9"), names, "y", 3).nodes == ()
    rules = [r["rule"] for r in model.rules(spark).orderBy("position").collect()]
    assert rules == ["If feature[0] <= 2.50", "    Predict: 1.00", "Else feature[0] > 2.50", "    Predict: 5.00"]
    assert [tuple(r) for r in model.importance(spark).collect()] == [("f0", 1.0)]
    again = TreeModel.from_table(model.table(spark), names)
    assert again == model


@pytest.mark.parametrize("options", [{}, {"local_values": 0}, {"local_values": 500}, {"local_values": 0, "buckets": 8}, {"local_values": 0, "buckets": 64, "cell_rows": 15}, {"local_values": 300, "checkpoint_every": 1}])
def test_tree_equals_brute_force(spark, options):
    x, y = sample(7)
    df, names = table(spark, x, y)
    check(fit_tree(df, names, "y", 3, **options), brute.tree(x, y, 3))


def test_tree_does_not_depend_on_partitions(spark):
    x, y = sample(8, n=200)
    df, names = table(spark, x, y)
    models = [fit_tree(df.repartition(n), names, "y", 3) for n in (1, 2, 7)]
    assert models[0] == models[1] == models[2]


def test_tree_takes_arrays_and_vectors(spark):
    x, y = sample(9, n=120)
    df, names = table(spark, x, y)
    plain = fit_tree(df, names, "y", 2)
    arrays = df.select("y", F.array(*names).alias("v"))
    vectors = VectorAssembler(inputCols=names, outputCol="v").transform(df).select("y", "v")
    for packed in (arrays, vectors):
        model = fit_tree(packed, "v", "y", 2)
        assert model.nodes == plain.nodes and model.features[1] == "v[1]"
        scored = score_tree(packed, model, "v")
        assert scored.columns == ["y", "v", "prediction"]
        assert scored.agg(F.sum("prediction")).first()[0] == pytest.approx(y.sum())


def test_tree_scores(spark):
    x, y = sample(10)
    df, names = table(spark, x, y)
    errors = []
    for depth in (1, 2, 4):
        model = fit_tree(df, names, "y", depth)
        leaves = [n for n in model.nodes if n.feature is None]
        assert sum(n.n for n in leaves) == len(y)
        scored = score_tree(df, model)
        counted = {r["prediction"]: r["count"] for r in scored.groupBy("prediction").count().collect()}
        assert sum(counted.values()) == len(y) and set(counted) == {n.prediction for n in leaves}
        errors.append(scored.agg(F.sum(F.pow(F.col("prediction") - F.col("y"), 2))).first()[0])
    assert errors == sorted(errors, reverse=True)
    # Own names of the rows are kept, whatever the walk uses; a missing value goes right.
    odd = df.select(F.lit(None).cast("double").alias("f0"), "f1", "f2", "f3", F.lit(9).alias("node"))
    row = score_tree(odd, fit_tree(df, ["f0"], "y", 1)).first()
    right = [n for n in fit_tree(df, ["f0"], "y", 1).nodes if n.node_id == 3][0]
    assert row["node"] == 9 and row["prediction"] == right.prediction


def test_tree_on_log_labels(spark):
    x, y = sample(11)
    df, names = table(spark, x, y)
    model = fit_tree(df.withColumn("z", log_label("y")), names, "z", 2)
    check(model, brute.tree(x, np.log1p(y), 2))
    leaf = {n.prediction for n in model.nodes if n.feature is None}
    got = {r[0] for r in score_tree(df, model, inverse=unlog_label).select("prediction").distinct().collect()}
    assert sorted(got) == pytest.approx(sorted(map(math.expm1, leaf)))


def test_tree_refuses_gaps(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 3.0), (float("nan"), 1.0)], "a double, y double")
    with pytest.raises(ValueError, match="2 rows"):
        fit_tree(df, ["a"], "y")


def test_large_whole_labels_do_not_overflow(spark):
    big = 2**61
    df = spark.createDataFrame([(1.0, big), (2.0, big), (3.0, -big), (4.0, -big), (5.0, big)], "a double, y bigint")
    assert fit_tree(df, ["a"], "y", 1).nodes[0].threshold == 2.5


def test_exact_tree_is_no_worse_than_a_binned_one(spark):
    x, y = sample(12)
    df, names = table(spark, x, y)
    exact = score_tree(df, fit_tree(df, names, "y", 1))
    rows = assemble(df, names)
    binned = L.fit_binned_tree(rows, "y", max_depth=1).transform(rows)

    def sse(d):
        return d.agg(F.sum(F.pow(F.col("prediction") - F.col("y"), 2))).first()[0]

    assert sse(exact) <= sse(binned) + 1e-6


def test_gradient_by_hand(spark):
    df = spark.createDataFrame([(2.0, 1.0)], "x double, y double")
    assert [tuple(r) for r in gradient(df, ["x"], "y", [0.0, 0.0]).collect()] == [("x", -1.0), ("intercept", -0.5)]


def logistic_sample(n=200, width=3):
    rng = np.random.default_rng(20)
    x = rng.normal(size=(n, width))
    y = (rng.random(n) < 1 / (1 + np.exp(-(x[:, 0] * 2 - x[:, 1] + 0.5)))).astype(float)
    return x, y


@pytest.mark.parametrize("reduce", ["sum", "mean"])
def test_descent_equals_numpy(spark, reduce):
    x, y = logistic_sample()
    df, names = table(spark, x, y)
    model = fit_logistic_gd(df.repartition(3), names, "y", step=0.01, iterations=6, reduce=reduce)
    expected = brute.descent(x, y, 0.01, 6, reduce == "mean")
    assert [*model.coefficients, model.intercept] == pytest.approx(expected.tolist())
    assert [r["term"] for r in model.terms(spark).collect()] == [*names, "intercept"]
    scored = score_logistic(df, model)
    p = 1 / (1 + np.exp(-(np.c_[x, np.ones(len(y))] @ expected)))
    got = scored.toPandas()
    assert got.probability.to_numpy() == pytest.approx(p) and ((got.prediction == 1) == (p >= 0.5)).all()
    with pytest.raises(ValueError):
        fit_logistic_gd(df, names, "y", reduce="max")


def test_wide_descent(spark):
    x, y = logistic_sample(width=5)
    df, names = table(spark, x, y)
    packed = df.select("y", F.array(*names).alias("v"))
    narrow = fit_logistic_gd(df, names, "y", iterations=3)
    wide = fit_logistic_gd(packed, "v", "y", iterations=3)
    assert wide.features == tuple(f"v[{i}]" for i in range(5)) and wide.coefficients == pytest.approx(narrow.coefficients)
    assert score_logistic(packed, wide, "v").columns == ["y", "v", "probability", "prediction"]
    # Rows of 300 features are scored by sums in groups.
    x, y = logistic_sample(n=40, width=300)
    df, names = table(spark, x, y)
    model = fit_logistic_gd(df.select("y", F.array(*names).alias("v")), "v", "y", iterations=2)
    z = x @ np.array(model.coefficients) + model.intercept
    got = [r["probability"] for r in score_logistic(df, LinearModel(tuple(names), model.coefficients, model.intercept)).collect()]
    assert sorted(got) == pytest.approx(sorted(1 / (1 + np.exp(-z))))


def test_steps_make_no_new_code(spark):
    x, y = logistic_sample(width=4)
    df, names = table(spark, x, y)
    compiled = spark._jvm.org.apache.spark.metrics.source.CodegenMetrics.METRIC_COMPILATION_TIME()
    counts = []
    for iterations in (2, 2, 12):
        before = compiled.getCount()
        fit_logistic_gd(df, names, "y", iterations=iterations)
        counts.append(compiled.getCount() - before)
    assert counts[2] <= counts[1] + 2


def test_gradient_leaves_out_rows_with_a_null(spark):
    rows = [(2.0, 1.0, 1.0), (None, 1.0, 0.0), (1.0, None, 0.0), (1.0, 5.0, None)]
    df = spark.createDataFrame(rows, "a double, b double, y double")
    assert {tuple(r) for r in gradient(df, ["a", "b"], "y", [0.0, 0.0, 0.0]).collect()} == {("a", -1.0), ("b", -0.5), ("intercept", -0.5)}
    assert gradient(df.limit(0), ["a", "b"], "y", [0.0, 0.0, 0.0]).agg(F.sum("g")).first()[0] in (None, 0.0)


@pytest.mark.parametrize("penalty", [0.0, 0.05])
def test_lbfgs_reaches_the_optimum_of_the_library(spark, penalty):
    x, y = logistic_sample(n=300, width=6)
    x[:, 2] *= 100
    x[:, 4] = 3.0
    df, names = table(spark, x, y)
    own = fit_logistic_lbfgs(df.repartition(3), names, "y", penalty=penalty)
    library = L.as_linear_model(L.fit_logistic(assemble(df, names), "y", regParam=penalty, tol=1e-12), names)
    assert own.coefficients == pytest.approx(library.coefficients, abs=1e-5) and own.intercept == pytest.approx(library.intercept, abs=1e-4)
    none = fit_logistic_lbfgs(df.limit(0), names, "y")
    assert none.coefficients == (0.0,) * 6 and none.intercept == 0.0
    with pytest.raises(ValueError, match="1 rows"):
        fit_logistic_lbfgs(df.unionByName(df.limit(1).withColumn("f1", F.lit(None).cast("double"))), names, "y")


def test_extreme_scores(spark):
    df = spark.createDataFrame([(0.0,), (1000.0,), (-1000.0,)], "x double")
    got = score_logistic(df, LinearModel(("x",), (1.0,), 0.0)).select("probability", "prediction").collect()
    assert [tuple(r) for r in got] == [(0.5, 1.0), (1.0, 1.0), (0.0, 0.0)]


def test_library_logistic_reaches_the_optimum(spark):
    x, y = logistic_sample()
    df, names = table(spark, x, y)
    model = L.as_linear_model(L.fit_logistic(assemble(df, names), "y", tol=1e-12), names)
    g = np.c_[x, np.ones(len(y))].T @ (1 / (1 + np.exp(-(x @ np.array(model.coefficients) + model.intercept))) - y)
    assert np.abs(g).max() < 1e-3


def test_library_auc_keeps_every_score(spark):
    x, y = logistic_sample()
    df, _ = table(spark, x, y)
    assert L.binned_auc(df, "y", "f0", bins=0) == pytest.approx(brute.auc(y, x[:, 0]))


def test_categorical_tree_splits_by_subset(spark):
    rows = [(float(k), 10.0 if k in (1, 3) else 0.0) for k in range(5) for _ in range(4)]
    df = assemble(L.with_arity(spark.createDataFrame(rows, "k double, y double"), {"k": 5}), ["k"])
    model = L.fit_binned_tree(df, "y", max_depth=1)
    assert model.numNodes == 3
    text = "\n".join(r["rule"] for r in L.tree_text(spark, model).collect())
    assert "in {" in text
    assert [tuple(r) for r in L.tree_importance(spark, model, ["k"]).collect()] == [("k", 1.0)]


def test_grid_search_takes_the_first_of_equals(spark):
    x, y = sample(13)
    df, names = table(spark, x, y)
    rows = assemble(df, names)
    found = grid_search(
        rows, rows, [{"max_depth": 1}, {"max_depth": 3}, {"max_depth": 3}],
        lambda part, max_depth: L.fit_binned_tree(part, "y", max_depth=max_depth), "y",
    )
    got = [(json.loads(r["params"]), r["is_best"]) for r in found.table.collect()]
    assert got == [({"max_depth": 1}, False), ({"max_depth": 3}, True), ({"max_depth": 3}, False)]
    assert found.params == {"max_depth": 3} and found.model.getMaxDepth() == 3
    assert found.model.getPredictionCol() == "prediction"


@pytest.mark.parametrize("buckets", [1, 8])
@pytest.mark.parametrize("parts", [1, 7])
def test_tree_stops_at_equal_real_labels(spark, buckets, parts):
    """Sums of doubles differ in their last digits; that is no gain."""
    for value in (0.1, math.log1p(455), 1e9 + 0.1):
        rows = [(float(i), float(i % 3), value) for i in range(60)]
        df = spark.createDataFrame(rows, "a double, b double, y double").repartition(parts)
        assert len(fit_tree(df, ["a", "b"], "y", 4, buckets=buckets).nodes) == 1
    values = [math.log1p(v) for v in (3, 455, 10, 77)]
    rows = [(float(i % 400), float(i % 7), values[i % 400 // 100]) for i in range(2000)]
    df = spark.createDataFrame(rows, "a double, b double, y double").repartition(parts)
    model = fit_tree(df, ["a", "b"], "y", 5, buckets=buckets)
    assert len(model.nodes) == 7
    assert sorted(n.prediction for n in model.nodes if n.feature is None) == pytest.approx(sorted(values), abs=1e-12)


def test_gain_of_small_differences_between_large_labels(spark):
    df = spark.createDataFrame([(1.0, 1e9), (2.0, 1e9 + 0.001)], "a double, y double")
    assert fit_tree(df, ["a"], "y", 1).nodes[0].gain == pytest.approx(2.5e-7, rel=1e-3)


def test_descent_refuses_nulls_and_thresholds_keep_them(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 0.0), (None, 1.0)], "x double, y double")
    with pytest.raises(ValueError, match="1 rows have a null"):
        fit_logistic_gd(df, ["x"], "y", iterations=2)
    model = fit_logistic_gd(df.dropna(), ["x"], "y", iterations=2)
    got = {r.x: (r.probability, r.prediction) for r in score_logistic(df, model).collect()}
    assert got[None] == (None, None) and got[1.0][1] in (0.0, 1.0)


def category_sample(n=500, seed=3):
    rng = np.random.default_rng(seed)
    x = np.c_[rng.integers(0, 7, n), rng.normal(size=n).round(1), rng.integers(0, 2, n)].astype(float)
    y = rng.integers(0, 40, n) + 30 * np.isin(x[:, 0], [1, 4, 6]) + np.floor(10 * x[:, 1]).astype(int) * (x[:, 2] > 0)
    return x, y


def best_set_split(x, y, categorical):
    """Every subset of the categories met, and every midpoint."""
    import itertools

    n, best = len(y), None
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        if f in categorical:
            sides = [np.isin(x[:, f], s) for k in range(1, len(values)) for s in itertools.combinations(values, k)]
        else:
            sides = [x[:, f] <= (a + b) / 2 for a, b in zip(values, values[1:])]
        for left in sides:
            a, b = y[left], y[~left]
            gain = len(a) * len(b) / n**2 * (a.mean() - b.mean()) ** 2
            best = max(best or 0.0, gain)
    return best


@pytest.mark.parametrize("local_values", [0, 400, 10**6])
def test_categories_are_split_by_the_best_set(spark, local_values):
    x, y = category_sample()
    df, names = table(spark, x, y)
    arity = {"f0": 7, "f2": 2}
    model = fit_tree(df.repartition(3), names, "y", 3, buckets=8, arity=arity, local_values=local_values)
    reached = {1: np.ones(len(y), bool)}
    for node in model.nodes:
        own = reached[node.node_id]
        assert node.n == own.sum() and node.prediction == pytest.approx(y[own].mean())
        if node.feature is not None:
            assert node.gain == pytest.approx(best_set_split(x[own], y[own], {0, 2}))
            column = x[:, node.feature]
            left = column <= node.threshold if node.subset is None else np.isin(column, categories(node.subset))
            reached |= {2 * node.node_id: own & left, 2 * node.node_id + 1: own & ~left}
    assert any(n.subset is not None for n in model.nodes) and any(n.threshold is not None for n in model.nodes)
    assert TreeModel.from_table(model.table(spark), names).nodes == model.nodes
    scored = score_tree(df, model)
    assert scored.agg(F.sum("prediction")).first()[0] == pytest.approx(y.sum())
    # An unknown category and a missing one go right.
    odd = df.limit(1).select("f1", "f2", F.explode(F.array(F.lit(None).cast("double"), F.lit(9.0), F.lit(70.0), F.lit(-1.0))).alias("f0"))
    assert len({r["prediction"] for r in score_tree(odd, fit_tree(df, ["f0"], "y", 1, arity={"f0": 7})).collect()}) == 1
    rules = [r["rule"] for r in model.rules(spark).collect()]
    assert any(" in {" in r for r in rules) and any("not in {" in r for r in rules)
    with pytest.raises(ValueError, match="no category"):
        fit_tree(df, names, "y", 1, arity={"f0": 3})
    with pytest.raises(ValueError, match="63"):
        fit_tree(df, names, "y", 1, arity={"f0": 64})


def jobs_of(spark, group, run):
    spark.sparkContext.setJobGroup(group, group)
    out = run()
    spark.sparkContext.setJobGroup("rest", "rest")
    return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_small_nodes_take_no_jobs_of_their_own(spark):
    x, y = sample(14, n=600)
    df, names = table(spark, x, y)
    deep, jobs = jobs_of(spark, "deep", lambda: fit_tree(df, names, "y", 10))
    assert jobs <= 6 and max(n.depth for n in deep.nodes) == 10
    # All levels in cells, the other way round.
    shallow, jobs = jobs_of(spark, "cells", lambda: fit_tree(df, names, "y", 2, buckets=8, local_values=0))
    assert jobs <= 2 * 13 + 4
    assert [(n.node_id, n.feature, n.threshold, n.n) for n in shallow.nodes] == [(n.node_id, n.feature, n.threshold, n.n) for n in deep.pruned(2).nodes]


def test_every_depth_comes_from_one_tree(spark):
    x, y = sample(15)
    df, names = table(spark, x, y)
    train, validation = df.filter("f2 < 0.5"), df.filter("f2 >= 0.5")
    depths = [1, 3, 6]
    found, jobs = jobs_of(spark, "nested", lambda: nested_search(train, validation, names, "y", depths))
    # One fit and one pass: more depths take no more jobs.
    _, deepest = jobs_of(spark, "deepest", lambda: nested_search(train, validation, names, "y", depths[-1:]))
    alone = [fit_tree(train, names, "y", d) for d in depths]
    assert jobs == deepest and found.model.nodes == alone[depths.index(found.params["max_depth"])].nodes
    scored = score_depths(validation, fit_tree(train, names, "y", 6), {f"p{d}": d for d in depths})
    for d, model in zip(depths, alone):
        want = score_tree(validation, model).agg(F.sum("prediction"), F.sum(F.pow(F.col("prediction") - F.col("y"), 2))).first()
        got = scored.agg(F.sum(f"p{d}"), F.sum(F.pow(F.col(f"p{d}") - F.col("y"), 2))).first()
        assert tuple(got) == pytest.approx(tuple(want))
        row = [r for r in found.table.collect() if json.loads(r["params"])["max_depth"] == d][0]
        assert row["value"] == pytest.approx((want[1] / validation.count()) ** 0.5)
