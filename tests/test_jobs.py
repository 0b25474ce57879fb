import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from arborlog import session
from arborlog.plans.fraud import run_fraud, run_fraud_file
from arborlog.plans.trips import FEATURES, clean_trips, run_trip_files, run_trips, trip_features
from arborlog.sources.delimited import header_of, preview, read_delimited, read_labelled, write_predictions
from checks import queries as Q
from checks import views as V

SMALL = "/root/testdata/sf0.001"
TINY_TREE = {"buckets": 4}


def test_delimited_files(spark, tmp_path):
    path = str(tmp_path / "rows")
    df = spark.createDataFrame([(1, 'say "a,b"', 2.5), (2, None, -1.0)], "id int, t string, v double")
    write_predictions(df, path, single_file=True)
    assert len([f for f in os.listdir(path) if f.endswith(".csv")]) == 1
    assert header_of(spark, path) == ["id", "t", "v"]
    back = read_delimited(spark, path, "id int, t string, v double")
    assert sorted(map(tuple, back.collect())) == [(1, 'say "a,b"', 2.5), (2, None, -1.0)]
    assert read_delimited(spark, path, infer=True, drop=["t"]).dtypes == [("id", "int"), ("v", "double")]
    assert read_delimited(spark, path).dtypes == [("id", "string"), ("t", "string"), ("v", "string")]
    write_predictions(df.limit(1), path)  # replaces what was there
    assert read_delimited(spark, path).count() == 1
    assert [r["id"] for r in preview(df.union(df), "id", 3).collect()] == [1, 1, 2]


def test_repeated_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,v\n1,2.5\nid,v\n2,x\n")
    (tmp_path / "b.csv").write_text("id,v\n3,4\n")
    df = read_delimited(spark, str(tmp_path), "id int, v double", repeated_header=True, mode="permissive")
    assert sorted(map(tuple, df.collect()), key=lambda r: r[0]) == [(1, 2.5), (2, None), (3, 4.0)]
    with pytest.raises(Exception, match="no double in column v: x"):
        read_delimited(spark, str(tmp_path), "id int, v double", repeated_header=True).collect()
    with pytest.raises(ValueError):
        read_delimited(spark, str(tmp_path), infer=True, repeated_header=True)


def test_columns_are_found_by_name_in_each_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b,y\n1,2,3\n")
    (tmp_path / "b.csv").write_text("y,b,a\n6,5,4\n")
    (tmp_path / "c.csv").write_text("a,b,y\n7,8,9\n")
    (tmp_path / "_empty.csv").write_text("")
    want = [(1.0, 2.0, 3.0), (4.0, 5.0, 6.0), (7.0, 8.0, 9.0)]
    assert sorted(map(tuple, read_labelled(spark, str(tmp_path)).collect())) == want
    assert sorted(map(tuple, read_delimited(spark, str(tmp_path), "y int, a int").collect())) == [(3, 1), (6, 4), (9, 7)]
    with pytest.raises(ValueError, match="no column z"):
        read_delimited(spark, str(tmp_path), "a int, z int")
    (tmp_path / "d.csv").write_text("a,b,y\n1,x,3\n")
    with pytest.raises(Exception, match="no int in column b: x"):
        read_delimited(spark, str(tmp_path), "a int, b int").collect()


def test_types_are_inferred_by_name(spark, tmp_path):
    (tmp_path / "a b%20.csv").write_text("a,b,only\n1,2,x\n")
    (tmp_path / "b.csv").write_text("\ufeffb,a,t\n20.5,10,2020-01-01\n")
    (tmp_path / "c.csv").write_text('"b","a","t"\n7,8,later\n')
    (tmp_path / "d.csv").write_text("")
    (tmp_path / "e.csv").write_text("a,b\n")
    df = read_delimited(spark, str(tmp_path), infer=True)
    assert dict(df.dtypes) == {"a": "int", "b": "double", "only": "string", "t": "string"}
    assert {tuple(r) for r in df.select("a", "b", "only", "t").collect()} == {(1, 2.0, "x", None), (10, 20.5, None, "2020-01-01"), (8, 7.0, None, "later")}
    empty = tmp_path / "none"
    empty.mkdir()
    assert read_delimited(spark, str(empty), infer=True).count() == 0 and read_delimited(spark, str(empty), "a int").columns == ["a"]


def test_many_files_take_few_jobs(spark, tmp_path):
    for i in range(2000):
        (tmp_path / f"{i:04}.csv").write_text("a,b\n1,2\n" if i % 2 else "b,a\n2,1\n")
    spark.sparkContext.setJobGroup("files", "files")
    df = read_delimited(spark, str(tmp_path), "a int, b int")
    total = df.agg(F.sum("a"), F.sum("b")).first()
    spark.sparkContext.setJobGroup("rest", "rest")
    assert tuple(total) == (2000, 4000)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("files")) < 20


def test_labelled_file(spark, tmp_path):
    path = tmp_path / "cards.csv"
    path.write_text('"Time","V1","Class"\n0,"-1.5","0"\n1,2e-1,"1"\n')
    df = read_labelled(spark, str(path))
    assert df.columns == ["Time", "V1", "label"] and {t for _, t in df.dtypes} == {"double"}
    assert [tuple(r) for r in df.orderBy("Time").collect()] == [(0.0, -1.5, 0.0), (1.0, 0.2, 1.0)]
    assert read_labelled(spark, str(path), "Time").columns == ["V1", "Class", "label"]
    path.write_text("a,y\n1,zero\n")
    with pytest.raises(Exception):
        read_labelled(spark, str(path)).collect()


def test_flag_is_encoded_once_and_alike(spark):
    trips = V.trips(spark, SMALL)
    train, test = trip_features(trips), trip_features(trips.drop("trip_duration"), labelled=False)
    assert test.columns == ["id", *FEATURES] and train.columns == [*test.columns, "trip_duration"]
    ones = [df.agg(F.sum("store_and_fwd_flag")).first()[0] for df in (train, test)]
    assert ones[0] == ones[1] == trips.filter("store_and_fwd_flag = 'Y'").count() > 0


def test_trip_files(spark, tmp_path):
    trips = V.trips(spark, SMALL).select(
        "id", "vendor_id", "pickup_datetime", F.lit("2024-01-01 00:00:00").alias("dropoff_datetime"), "passenger_count",
        "pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude", "store_and_fwd_flag",
        "trip_duration",
    )
    train, test, out = (str(tmp_path / n) for n in ("train", "test", "out"))
    write_predictions(trips, train)
    write_predictions(trips.drop("dropoff_datetime", "trip_duration"), test)
    for kind in ("binned", "categorical", "exact"):
        result = run_trip_files(spark, train, test, out, kind)
        written = read_delimited(spark, out, "id string, trip_duration double")
        assert written.columns == ["id", "trip_duration"]
        assert written.count() == trips.count() and written.filter("trip_duration IS NULL").count() == 0
        quality = {r["metric"]: r["value"] for r in result.metrics.collect()}
        assert quality["rmse"] > 0 and quality["r2"] > 0.3, kind
        assert result.rules.count() > 3
        assert result.importance.agg(F.sum("importance")).first()[0] == pytest.approx(1.0)
        assert (result.search is None) == (kind == "exact")
    with pytest.raises(ValueError):
        run_trips(trips, kind="other")


def test_best_model_scores_the_test_trips(spark):
    trips = V.trips(spark, SMALL)
    result = run_trips(trips, trips.drop("trip_duration"), "binned")
    best = result.search.filter("is_best").first()
    assert best["value"] == pytest.approx(result.metrics.filter("metric = 'rmse'").first()["value"])
    assert best["value"] == result.search.agg(F.min("value")).first()[0]


def test_exact_job_in_cells_equals_the_plain_one(spark):
    trips = V.trips(spark, SMALL)
    plain = run_trips(trips, kind="exact", max_depth=2)
    cells = run_trips(trips, kind="exact", max_depth=2, buckets=4)
    assert [tuple(r) for r in plain.rules.collect()] == [tuple(r) for r in cells.rules.collect()]


def counted(spark, trips):
    """Trips that count how often one of them is worked out."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def count(value):
        seen.add(1)
        return value

    return trips.withColumn("vendor_id", count("vendor_id")), seen


def test_trips_are_worked_out_once(spark):
    plain = V.trips(spark, SMALL)
    train, seen = counted(spark, plain)
    test, seen_test = counted(spark, plain.drop("trip_duration"))
    baseline = spark.createDataFrame([("rmse", 1.0), ("r2", 0.5)], "metric string, value double")
    result = run_trips(train, test, "exact", max_depth=2, buckets=4, local_values=0, baseline=baseline)
    assert result.metrics.count() == result.delta.count() == 2 and result.nulls.filter("null_count > 0").count() == 0
    assert result.predictions.count() == result.predictions.select("id").distinct().count() == plain.count()
    assert (seen.value, seen_test.value) == (plain.count(), plain.count())


def test_tree_queries_work_out_the_trips_once(spark, monkeypatch):
    rows, seen = counted(spark, V.trips(spark, SMALL))
    monkeypatch.setattr(Q.V, "trips", lambda *_: rows)
    assert Q.exact_tree_categorical(spark, SMALL).count() > 1
    assert seen.value == rows.count()


def test_fraud_job(spark, tmp_path):
    cards = V.cards(spark, SMALL)
    found = {s: run_fraud(cards, keys=["event_id"], solver=s, scale=True, **kw) for s, kw in (("lbfgs", {}), ("gd", {}))}
    for result in found.values():
        report = {(r["split"], r["metric"], r["label"]): r["value"] for r in result.report.collect()}
        assert len(report) == 14 and report[("train", "auc", None)] > 0.6
        assert result.train.count() + result.test.count() == cards.count()
    path = str(tmp_path / "cards")
    write_predictions(cards.select("amount", "hour_share", "label"), path)
    assert run_fraud_file(spark, path, "gd", scale=True).report.count() == 14
    with pytest.raises(ValueError):
        run_fraud(cards, solver="other")


def test_clean_trips_keeps_the_borders(spark):
    rows = trip_features(V.trips(spark, SMALL))
    kept = clean_trips(rows).agg(F.min("passenger_count"), F.max("passenger_count")).first()
    assert tuple(kept) == (1, 6) and rows.agg(F.max("passenger_count")).first()[0] == 8


def test_shared_folder(spark, monkeypatch):
    named = session.shared_folder(spark)
    assert named == session.shared_folder(spark) and session.new_path(spark, "x").startswith(named)

    class Cluster:
        master, applicationId = "spark://host:7077", "app"

        def getConf(self):
            return self

        def get(self, key, default=None):
            return default

    class Session:
        sparkContext = Cluster()
        conf = Cluster()

    with pytest.raises(ValueError):
        session.shared_folder(Session())


def test_command_line_help():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-m", "arborlog", "trips", "--help"], cwd=root, capture_output=True, text=True)
    assert out.returncode == 0 and "--tree" in out.stdout
