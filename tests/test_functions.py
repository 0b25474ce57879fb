import datetime
import math

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from arborlog.functions import encode as E
from arborlog.functions import linear as LIN
from arborlog.functions.calendar import calendar_parts, parse_timestamp
from arborlog.functions.geo import great_circle


def column(df, name="v"):
    return [r[name] for r in df.collect()]


def test_great_circle(spark):
    rows = [(0.0, 0.0, 1.0, 0.0), (5.0, 6.0, 5.0, 6.0), (None, 0.0, 1.0, 0.0), (0.0, 0.0, 180.0, 0.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    got = column(df.select(great_circle("a", "b", "c", "d").alias("v")))
    assert got[0] == pytest.approx(111.194927, abs=1e-6)
    assert got[1:3] == [0.0, 0.0]
    assert got[3] == pytest.approx(math.pi * 6371)
    assert column(df.select(great_circle("a", "b", "c", "d", on_null=None).alias("v")))[2] is None
    text = spark.createDataFrame([("x", 0.0, 1.0, 0.0)], "a string, b double, c double, d double")
    assert column(text.select(great_circle("a", "b", "c", "d").alias("v"))) == [0.0]


def test_timestamps(spark):
    df = spark.createDataFrame([("2016-03-14 17:24:55",), ("x",), (None,), ("2016-03-13 02:30:00",)], "t string")
    parsed = parse_timestamp(df, "t")
    assert column(parsed, "t") == [
        datetime.datetime(2016, 3, 14, 17, 24, 55), None, None, datetime.datetime(2016, 3, 13, 2, 30),
    ]
    first = calendar_parts(parsed, "t", "p").drop("t").first()
    assert tuple(first) == (2016, 3, 14, 17, 24, 55)
    assert first.asDict().keys() == {"p_year", "p_month", "p_day", "p_hour", "p_min", "p_sec"}
    other = spark.createDataFrame([("14/03/2016",), ("2016",)], "t string")
    assert column(parse_timestamp(other, "t", "dd/MM/yyyy"), "t") == [datetime.datetime(2016, 3, 14), None]
    assert column(parse_timestamp(df, "t", None, "u").select("u"), "u")[0] == datetime.datetime(2016, 3, 14, 17, 24, 55)


def test_wall_clock_survives_a_skipped_hour(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = parse_timestamp(spark.createDataFrame([("2016-03-13 02:30:00",)], "t string"), "t")
        assert calendar_parts(df, "t", "p").first()["p_hour"] == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_flag_and_category(spark):
    df = spark.createDataFrame([("Y",), ("N",), ("y",), (None,)], "f string")
    assert column(E.flag_encode(df, "f"), "f") == [1, 0, 0, 0]
    coded = E.category_index(df, "f", ["N", "Y"], "k")
    assert column(coded, "k") == [1.0, 0.0, None, None]
    assert coded.schema["k"].metadata["ml_attr"]["vals"] == ["N", "Y"]


def test_log_label(spark):
    df = spark.createDataFrame([(0.0,), (math.e - 1,), (1234.5,)], "y double")
    assert column(df.select(E.log_label("y").alias("v"))) == pytest.approx([0.0, 1.0, math.log(1235.5)])
    assert column(df.select(E.unlog_label(E.log_label("y")).alias("v"))) == pytest.approx([0.0, math.e - 1, 1234.5])


def test_assemble(spark):
    df = spark.createDataFrame([(1, 2.0), (3, None)], "a int, b double")
    assert column(E.assemble(df, ["a", "b"], as_array=True, handle_invalid="keep"), "features") == [[1, 2], [3, None]]
    assert column(E.assemble(df, ["a", "b"], as_array=True, handle_invalid="skip"), "features") == [[1, 2]]
    vector = E.assemble(df, ["a", "b"], handle_invalid="skip").withColumn("v", vector_to_array("features"))
    assert column(vector) == [[1, 2]]
    for as_array in (True, False):
        with pytest.raises(Exception):
            E.assemble(df, ["a", "b"], as_array=as_array).collect()
    with pytest.raises(ValueError):
        E.assemble(df, ["a"], as_array=True, handle_invalid="other")


def test_to_double_and_feature_columns(spark):
    df = spark.createDataFrame([("1.5", "x", 1)], "a string, b string, y int")
    assert tuple(E.to_double(df, ["a", "b"]).first()) == (1.5, None, 1)
    assert E.feature_columns(df, "y") == ["a", "b"]
    assert E.feature_columns(df, "y", drop=["a"]) == ["b"]


def test_linear(spark):
    df = spark.createDataFrame([(0.0,), (1000.0,), (-1000.0,)], "z double")
    p = LIN.sigmoid(F.col("z"))
    assert column(df.select(p.alias("v"))) == [0.5, 1.0, 0.0]
    assert column(df.select(LIN.hard_label(p).alias("v"))) == [1.0, 1.0, 0.0]
    one = spark.createDataFrame([([1.0, 2.0], [3.0, 4.0], 5.0)], "a array<double>, b array<double>, `odd.name` double")
    assert column(one.select(LIN.dot_arrays(F.col("a"), F.col("b")).alias("v"))) == [11.0]
    assert column(one.select(LIN.add_arrays(F.col("a"), F.col("b")).alias("v"))) == [[4.0, 6.0]]
    assert column(one.select(LIN.scale_array(F.col("a"), 2).alias("v"))) == [[2.0, 4.0]]
    assert column(one.select(LIN.dot(["a[0]", "`odd.name`"], [2, -1e-7]).alias("v"))) == [2 - 5e-7]
    assert math.isinf(column(one.select(LIN.dot(["a[0]"], [float("inf")]).alias("v")))[0])
