import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from arborlog.functions.buckets import bucket_count, buckets_for, quantile_bounds, with_buckets, with_fine_buckets
from arborlog.operators import metrics as M
from arborlog.operators.moments import moments, zscore
from arborlog.operators.prefix import prefix_sums, tie_ranks
from arborlog.operators.quality import Range, drop_nulls, null_profile, range_filter
from arborlog.operators.sampling import hash_split
from tests import brute


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def kept(df):
    return [tuple(r)[0] for r in df.collect()]


def test_range_filter(spark):
    seconds = frame(spark, [(0,), (1,), (35999,), (36000,), (None,)], "d int")
    assert kept(range_filter(seconds, [Range("d", 0, 36000, "neither")])) == [1, 35999]
    people = frame(spark, [(0,), (1,), (6,), (7,)], "d int")
    assert kept(range_filter(people, [("d", 1, 6)])) == [1, 6]
    km = frame(spark, [(0.0,), (50.0,), (100.0,)], "d double")
    assert kept(range_filter(km, [("d", 0, 100, "left")])) == [0.0, 50.0]
    assert kept(range_filter(km, [("d", 0, 100, "right")])) == [50.0, 100.0]
    with pytest.raises(ValueError):
        range_filter(km, [("d", 0, 1, "open")])


def test_nulls(spark):
    df = frame(spark, [(1, None), (None, None), (3, "x")], "a int, `it's.b` string")
    assert {tuple(r) for r in null_profile(df).collect()} == {("a", 1), ("it's.b", 2)}
    assert drop_nulls(df).count() == 1
    assert drop_nulls(df, ["a"]).count() == 2


def test_hash_split_is_stable_and_complete(spark):
    df = spark.range(5000).withColumn("k", F.col("id") % 1000)
    parts = [{r[0] for r in p.select("id").collect()} for p in hash_split(df, "id")]
    assert not parts[0] & parts[1] and len(parts[0] | parts[1]) == 5000
    assert 0.77 < len(parts[0]) / 5000 < 0.83
    for n in (1, 2, 7):
        again = hash_split(df.repartition(n), ["id"])[0]
        assert {r[0] for r in again.select("id").collect()} == parts[0]
    by_key = [{r[0] for r in p.select("k").distinct().collect()} for p in hash_split(df, "k")]
    assert not by_key[0] & by_key[1]
    other = {r[0] for r in hash_split(df, "id", seed=7)[0].select("id").collect()}
    assert other != parts[0]
    assert hash_split(df, "id", 1.0)[1].count() == 0
    many = spark.range(200_000)
    few = hash_split(many, "id", 0.0004)[0].count()
    assert 40 < few < 130 and hash_split(many, "id", 0.9996)[1].count() in range(40, 130)


def test_moments(spark):
    df = frame(spark, [(1.0, 5), (2.0, 5), (3.0, 5), (4.0, 5)], "a double, b int")
    got = {r["feature"]: (r["n"], r["mean"], r["std"]) for r in moments(df, ["a", "b"]).collect()}
    assert got["a"] == (4, 2.5, pytest.approx(1.118034, abs=1e-6)) and got["b"] == (4, 5.0, 1.0)
    assert tuple(moments(df.filter("a > 9"), ["a"]).first()) == ("a", 0, 0.0, 1.0)
    scaled = zscore(df, ["a", "b"], moments(df, ["a", "b"]))
    again = {r["feature"]: (r["mean"], r["std"]) for r in moments(scaled, ["a", "b"]).collect()}
    assert again["a"] == pytest.approx((0.0, 1.0)) and again["b"] == (0.0, 1.0)


def test_buckets_follow_the_sort_order(spark):
    rng = np.random.default_rng(1)
    rows = [(float(v),) for v in rng.integers(0, 50, 500)] + [(None,), (float("nan"),), (float("-inf"),), (float("inf"),)]
    df = frame(spark, rows, "v double")
    bounds = quantile_bounds(df, ["v"], 8)
    got = with_buckets(df, {"v": "b"}, bounds).orderBy("v").select("b").collect()
    numbers = [r[0] for r in got]
    assert numbers == sorted(numbers) and len(set(numbers)) > 4
    per_value = with_buckets(df, {"v": "b"}, bounds).groupBy("v").agg(F.countDistinct("b").alias("d"))
    assert per_value.filter("d > 1").count() == 0
    assert bucket_count(10) == 8 and bucket_count(10**13) == 65_536
    # Bounds from a part of the rows cut just as well.
    many = spark.range(20000).selectExpr("CAST(id AS DOUBLE) AS v")
    cut = with_buckets(many, {"v": "b"}, quantile_bounds(many, ["v"], 4, rows=20000)).groupBy("b").count().collect()
    assert len(cut) == 4 and all(3500 < r["count"] < 6500 for r in cut)
    # One value everywhere gives one bound and still a valid numbering.
    same = frame(spark, [(1.0,)] * 20, "v double")
    assert with_buckets(same, {"v": "b"}, quantile_bounds(same, ["v"], 8)).select("b").distinct().count() == 1


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.sampled_from("ab"), st.integers(-3, 3), st.integers(0, 9)), min_size=1, max_size=60),
    st.sampled_from([1, 2, 5]),
)
def test_prefix_sums(spark, rows, buckets):
    df = frame(spark, rows, "g string, v int, w int").repartition(3)
    got = prefix_sums(df, "v", {"n": F.lit(1), "w": F.col("w")}, ["g"], buckets)
    expected = []
    for g in sorted({r[0] for r in rows}):
        values = sorted({r[1] for r in rows if r[0] == g})
        n = w = 0
        for v, after in zip(values, [*values[1:], None]):
            here = [r[2] for r in rows if r[:2] == (g, v)]
            n, w = n + len(here), w + sum(here)
            expected.append((g, v, len(here), sum(here), n, w, after))
    assert sorted(map(tuple, got.collect()), key=lambda r: r[:2]) == expected


def test_prefix_sums_with_a_hot_value_nulls_and_partitions(spark):
    rng = np.random.default_rng(2)
    rows = [(5.0,)] * 400 + [(float(v),) for v in rng.normal(5, 2, 700)] + [(None,)] * 3
    plain = None
    for parts in (1, 2, 7):
        for buckets in (1, 16):
            df = frame(spark, rows, "v double").repartition(parts)
            got = sorted(map(tuple, prefix_sums(df, "v", {"n": F.lit(1)}, buckets=buckets).collect()), key=lambda r: r[2])
            plain = plain or got
            assert got == plain
    assert plain[0] == (None, 3, 3, plain[1][0]) and plain[-1][2] == 1103


def test_prefix_sums_cut_buckets_in_two_levels(spark):
    rng = np.random.default_rng(8)
    values = [float(v) for v in rng.lognormal(0, 3, 900)] + [None, None, float("nan"), float("inf"), float("-inf"), -0.0, 0.0] + [7.0] * 300
    rows = [("ab"[i % 3 == 0], v) for i, v in enumerate(values)]
    df = frame(spark, rows, "g string, v double").repartition(5)
    plain, fine = (
        sorted(map(str, prefix_sums(df, "v", {"n": F.lit(1)}, ["g"], buckets, coarse=4).collect())) for buckets in (1, 40)
    )
    assert plain == fine
    # The numbers follow the order, no value is split, and the fine buckets are even.
    cut, any_bounds = with_fine_buckets(df.select("v").distinct(), "v", 40, coarse=4)
    numbers = [r[0] for r in cut.orderBy("v").select("_bucket").collect()]
    assert any_bounds and numbers == sorted(numbers) and len(set(numbers)) > 30 and max(map(numbers.count, set(numbers))) < 80
    nothing, any_bounds = with_fine_buckets(df.filter("v IS NULL").select("v"), "v", 40, coarse=4)
    assert not any_bounds and nothing.select("_bucket").distinct().collect() == [(0,)]
    assert buckets_for(10**13) == 200_000_000
    assert prefix_sums(df.limit(0), "v", {"n": F.lit(1)}).count() == 0


@pytest.mark.parametrize("operator", ["prefix_sums", "tie_ranks", "auc_rank"])
def test_running_sums_read_the_source_once(spark, operator):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    source = frame(spark, [(i % 97 / 97, i % 2) for i in range(3000)], "s double, y int").mapInPandas(counted, "s double, y int")
    run = {
        "prefix_sums": lambda: prefix_sums(source, "s", {"n": F.lit(1)}, coarse=4, buckets=20),
        "tie_ranks": lambda: tie_ranks(source, "s"),
        "auc_rank": lambda: M.auc_rank(source, "y", "s"),
    }[operator]
    assert run().count() > 0 and seen.value == 3000


def test_tie_ranks(spark):
    df = frame(spark, [(3,), (1,), (3,), (3,), (9,)], "s int")
    for buckets in (1, 3):
        got = {r["s"]: (r["n"], r["avg_rank"]) for r in tie_ranks(df, "s", buckets=buckets).collect()}
        assert got == {1: (1, 1.0), 3: (3, 3.0), 9: (1, 5.0)}


FIVE = [(1.0, 1), (1.0, 0), (0.0, 0), (0.0, 0), (0.0, 1)]


def test_class_metrics(spark):
    df = frame(spark, FIVE, "p double, y int")
    got = {(r["metric"], r["label"]): r["value"] for r in M.class_metrics(df, "y", "p").collect()}
    assert got == pytest.approx(
        {("accuracy", None): 0.6, ("precision", 1): 0.5, ("recall", 1): 0.5, ("precision", 0): 2 / 3, ("recall", 0): 2 / 3}
    )
    assert {tuple(r) for r in M.confusion(df, "y", "p").collect()} == {(1, 1, 1), (0, 1, 1), (0, 0, 2), (1, 0, 1)}
    empty = M.class_metrics(df.filter("y > 5"), "y", "p").collect()
    assert len(empty) == 5 and all(r["value"] == 0.0 for r in empty)
    never = {(r["metric"], r["label"]): r["value"] for r in M.class_metrics(df, "y", "p", labels=[7]).collect()}
    assert never[("precision", 7.0)] == never[("recall", 7.0)] == 0.0


def test_auc(spark):
    def auc(rows, **kw):
        return M.auc_rank(frame(spark, rows, "s double, y int"), "y", "s", **kw).first()["auc"]

    assert auc(FIVE) == pytest.approx(0.583333, abs=1e-6)
    assert auc([(0.1, 0), (0.4, 0), (0.35, 1), (0.8, 1)]) == 0.75
    assert auc([(0.3, 0), (0.3, 1), (0.3, 1)]) == 0.5
    assert auc([(0.3, 1), (0.4, 1)]) == 0.0
    rng = np.random.default_rng(3)
    y, s = rng.integers(0, 2, 300).tolist(), np.round(rng.normal(size=300), 1).tolist()
    for buckets in (1, 7):
        got = auc(list(zip(s, y)), buckets=buckets)
        assert got == pytest.approx(brute.auc(y, s), abs=1e-12)
        assert auc([(-a, b) for a, b in zip(s, y)], buckets=buckets) == pytest.approx(1 - got, abs=1e-12)
    # Hard predictions: the mean of the two recalls.
    hard = list(zip([float(v > 0) for v in s], y))
    df = frame(spark, hard, "s double, y int")
    recall = [r["value"] for r in M.class_metrics(df, "y", "s").collect() if r["metric"] == "recall"]
    assert auc(hard) == pytest.approx(sum(recall) / 2, abs=1e-12)


def test_auc_by_group(spark):
    rows = [("a", 0.1, 0), ("a", 0.9, 1), ("b", 0.9, 0), ("b", 0.1, 1), ("c", 0.5, 1)]
    df = frame(spark, rows, "g string, s double, y int")
    assert {r["g"]: r["auc"] for r in M.auc_rank(df, "y", "s", by=["g"], buckets=3).collect()} == {"a": 1, "b": 0, "c": 0}


def test_regression_metrics(spark):
    df = frame(spark, [(2.0, 1.0), (4.0, 5.0), (None, 7.0)], "p double, y double")
    assert tuple(M.regression_metrics(df, "y", "p").first()) == (2, 1.0, 0.75)
    flat = frame(spark, [(2.0, 3.0), (4.0, 3.0)], "p double, y double")
    assert M.regression_metrics(flat, "y", "p").first()["r2"] == 0.0


def test_joined_metrics_equal_the_pairs(spark):
    rng = np.random.default_rng(4)
    keys = [0] * 60 + rng.integers(0, 9, 60).tolist()
    p = frame(spark, [(k, float(v)) for k, v in zip(keys, rng.normal(10, 3, 120))], "k int, p double")
    y = frame(spark, [(k, float(v)) for k, v in zip(keys[::-1], rng.normal(11, 3, 120))], "k int, y double")
    pairs = M.join_predictions(p, y, "k").toPandas()
    labels = y.toPandas()["y"].to_numpy()
    ss = ((pairs.p - pairs.y) ** 2).sum()
    got = M.joined_regression_metrics(p, y, "k", "y", "p").first()
    assert got["n"] == len(pairs)
    assert got["rmse"] == pytest.approx(np.sqrt(ss / len(pairs)))
    assert got["r2"] == pytest.approx(1 - ss / ((labels - labels.mean()) ** 2).sum())


def test_report_and_delta(spark):
    df = frame(spark, FIVE, "p double, y int").withColumn("s", F.col("p") * 2)
    rows = M.metric_report({"train": df, "test": df.filter("p = 1")}, "y", "p", "s").collect()
    got = {(r["split"], r["metric"], r["label"]): r["value"] for r in rows}
    assert len(rows) == 14 and got[("train", "accuracy", None)] == 0.6 and got[("test", "accuracy", None)] == 0.5
    assert got[("train", "auc", None)] == got[("train", "auc_hard", None)] == pytest.approx(0.583333, abs=1e-6)
    now = frame(spark, [("rmse", 3.0), ("r2", 0.5)], "metric string, value double")
    before = frame(spark, [("rmse", 5.0), ("r2", 0.25)], "metric string, value double")
    assert {tuple(r) for r in M.metric_delta(now, before).collect()} == {("rmse", 3.0, 5.0, -2.0), ("r2", 0.5, 0.25, 0.25)}


def test_auc_leaves_out_rows_without_a_score(spark):
    rows = [(0, 0.1), (0, 0.4), (1, 0.35), (1, 0.8), (1, None), (0, float("nan"))]
    df = frame(spark, rows, "y int, s double")
    assert M.auc_rank(df, "y", "s").first()["auc"] == pytest.approx(0.75)


def test_roc_points(spark):
    rng = np.random.default_rng(6)
    y, s = rng.integers(0, 2, 400).tolist(), np.round(rng.normal(size=400), 2).tolist()
    df = frame(spark, [*zip(y, s), (1, None), (0, float("nan"))], "y int, s double")
    distinct = sorted(set(s), reverse=True)
    for bins in (0, 10, 1000):
        group = max(1, len(distinct) // bins) if bins else 1
        cuts = [distinct[min(i + group, len(distinct)) - 1] for i in range(0, len(distinct), group)]
        want = [(c, sum(v >= c and k == 1 for v, k in zip(s, y)) / sum(y), sum(v >= c and k == 0 for v, k in zip(s, y)) / (len(y) - sum(y))) for c in cuts]
        for parts in (1, 5):
            got = M.roc_curve(df.repartition(parts), "y", "s", bins).orderBy(F.desc("threshold")).collect()
            assert np.array(got) == pytest.approx(np.array(want))
        x, h = [0.0, *(w[2] for w in want), 1.0], [0.0, *(w[1] for w in want), 1.0]
        area = sum((b - a) * (c + d) / 2 for a, b, c, d in zip(x, x[1:], h, h[1:]))
        assert M.curve_area(M.roc_curve(df, "y", "s", bins)).first()["auc"] == pytest.approx(area)
        if bins != 10:
            assert area == pytest.approx(brute.auc(y, s))
    assert M.roc_curve(df.limit(0), "y", "s").count() == 0 and M.curve_area(M.roc_curve(df.limit(0), "y", "s")).first()["auc"] == 0.0
    assert {r["fpr"] for r in M.roc_curve(df.filter("y = 1"), "y", "s").collect()} == {0.0}


def test_hot_keys_are_split_without_adaptive_execution(spark):
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "64"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        left = spark.range(30_000).selectExpr("CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS k", "id AS a")
        right = spark.range(30_000).selectExpr("id AS k", "id * 2 AS b")
        joined = M.join_skewed(left, right, "k")
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 30_000 and max(sizes) < 0.06 * sum(sizes)
        assert joined.exceptAll(left.join(right, "k")).count() == 0
        # Hot on both sides, and rows that repeat.
        a = spark.range(900).selectExpr("CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS k", "1 AS a")
        b = spark.range(600).selectExpr("CASE WHEN id % 2 = 0 THEN 7 ELSE id END AS k", "2 AS b")
        both = M.join_skewed(a.unionByName(a.limit(5).withColumn("k", F.lit(None).cast("bigint"))), b, "k")
        sizes = [r["count"] for r in both.groupBy(F.spark_partition_id()).count().collect()]
        assert both.columns == ["k", "a", "b"] and both.groupBy("k").count().exceptAll(a.join(b, "k").groupBy("k").count()).count() == 0
        assert sum(sizes) == a.join(b, "k").count() and max(sizes) < 0.1 * sum(sizes)
        assert M.join_skewed(a.limit(0), b, "k").count() == 0
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
