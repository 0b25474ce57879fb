"""Readers and writers for delimited text with a header line."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from functools import reduce
from operator import and_
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arborlog.functions.text import quoted


def _names(line: str) -> list[str]:
    """Column names of a header line, as the reader names them: a column without a name by its place, a repeated name with its place."""
    names = next(csv.reader([line.removeprefix("\ufeff")], escapechar="\\"), [])
    lower = [n.lower() for n in names]
    return [f"_c{i}" if not n else f"{n}{i}" if lower.count(n.lower()) > 1 else n for i, n in enumerate(names)]


def _fields(schema: T.StructType | str) -> list[T.StructField]:
    return (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields


def _files(spark: SparkSession, path: str) -> list[tuple[list[str], str | list[str]]]:
    """The headers below ``path``, in the order of their first files, each with what to read by it: ``path`` itself or its files.

    Files of one folder may order their columns differently, and each is read by its own header. The executors find the first line
    of every file in one pass over the lines; only different headers reach the driver, and the names of files if there are
    several headers.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    # Numbers grow with the place in a file, as the start of a file is read by one task.
    lines = lines.filter("block = 0 AND trim(value) <> ''").withColumn("at", F.monotonically_increasing_id())
    first = lines.groupBy("file").agg(F.min_by("value", "at").alias("line"))
    headers = first.groupBy("line").agg(F.min("file").alias("first")).orderBy("first").collect()
    if len(headers) == 1:
        return [(_names(headers[0]["line"]), path)]
    files: dict[str, list[str]] = {r["line"]: [] for r in headers}
    if headers:
        for r in first.orderBy("file").collect():
            files[r["line"]].append(unquote(r["file"]))
    return [(_names(line), own) for line, own in files.items()]


def header_of(spark: SparkSession, path: str) -> list[str]:
    """Column names of the first file below ``path`` that has a line; none if no file has one."""
    groups = _files(spark, path)
    return groups[0][0] if groups else []


def _read(spark: SparkSession, paths: str | list[str], header: Sequence[str], types: Sequence[T.DataType]) -> DataFrame:
    schema = T.StructType([T.StructField(n, t) for n, t in zip(header, types, strict=True)])
    return spark.read.csv(paths, header=True, schema=schema).select(*[F.col(quoted(n)) for n in header])


# Types that inference gives to numbers, narrow to wide.
_NUMBERS = [T.IntegerType(), T.LongType(), T.DoubleType()]


def _wider(one: T.DataType, two: T.DataType) -> T.DataType:
    """The type that holds what files with these inferred types hold; text if no other does."""
    if one == two:
        return one
    if one in _NUMBERS and two in _NUMBERS:
        return _NUMBERS[max(_NUMBERS.index(one), _NUMBERS.index(two))]
    return T.StringType()


def _read_inferred(spark: SparkSession, path: str) -> DataFrame:
    """Files with types inferred, merged by the name of a column; a column that a file lacks is null there."""
    groups = _files(spark, path)
    types: dict[str, T.DataType] = {}
    for header, own in groups:
        found = spark.read.csv(own, header=True, inferSchema=True)
        if found.isEmpty():  # files without a row say nothing about types
            continue
        for name, field in zip(header, found.schema.fields):
            types[name] = _wider(types.get(name, field.dataType), field.dataType)
    parts = [_read(spark, own, header, [types.get(n, T.StringType()) for n in header]) for header, own in groups]
    if not parts:
        return spark.createDataFrame([], T.StructType([]))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _cast(column: Column, field: T.StructField, mode: str) -> Column:
    """Text to the type of ``field``. What does not fit raises, unless ``mode`` is permissive: then it is null."""
    typed = column.try_cast(field.dataType)
    if mode == "permissive":
        return typed.alias(field.name)
    message = F.concat(F.lit(f"no {field.dataType.simpleString()} in column {field.name}: "), column)
    bad = typed.isNull() & column.isNotNull()
    return F.when(bad, F.raise_error(message).cast(field.dataType)).otherwise(typed).alias(field.name)


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    drop: Sequence[str] = (),
    infer: bool = False,
    repeated_header: bool = False,
    mode: str = "failfast",
) -> DataFrame:
    """Read a file or folder of delimited text with a header.

    Columns are found by their name in the header of each file, so the order of a file does not matter; with a ``schema`` a
    missing column is an error, other columns are left out, and a text that does not fit its type raises (``mode`` permissive
    makes it null). ``infer`` costs a pass over the data and gives each column the widest type that its files need, a column that a
    file lacks being null there; without both all columns are text. ``drop`` names columns to
    leave out. With ``repeated_header`` lines equal to the header are dropped wherever they stand, as in files that were joined
    together.
    """
    if mode not in ("failfast", "permissive"):
        raise ValueError(f"mode must be failfast or permissive, not {mode!r}")
    if repeated_header and infer:
        raise ValueError("repeated_header needs a schema or text columns, not inference")
    if schema is None and infer:
        return _read_inferred(spark, path).drop(*drop)
    fields = _fields(schema) if schema is not None else None
    groups = _files(spark, path)
    if not groups:
        return spark.createDataFrame([], T.StructType(fields or [])).drop(*drop)
    return _typed(groups, spark, fields, mode, repeated_header).drop(*drop)


def _typed(groups: list[tuple[list[str], str | list[str]]], spark: SparkSession, fields: list[T.StructField] | None, mode: str, repeated_header: bool) -> DataFrame:
    """The files of all headers as one table, with ``fields`` by name or all columns as text."""
    parts = []
    for header, files in groups:
        df = _read(spark, files, header, [T.StringType()] * len(header))
        if repeated_header:
            df = df.filter(~reduce(and_, [F.col(quoted(c)).eqNullSafe(F.lit(c)) for c in header]))
        if fields is not None:
            missing = [f.name for f in fields if f.name not in header]
            if missing:
                raise ValueError(f"{files if isinstance(files, str) else files[0]} has no column {', '.join(missing)}")
            df = df.select(*[_cast(F.col(quoted(f.name)), f, mode) for f in fields])
        parts.append(df)
    return reduce(DataFrame.unionByName, parts)


def read_labelled(spark: SparkSession, path: str, label: str | None = None) -> DataFrame:
    """Read quoted delimited text whose fields are all numbers; every column is double.

    The label (``label``, else the last column of the first file) is renamed to ``label`` and stands last. Columns are found by
    name in each file. A field that is no number raises.
    """
    groups = _files(spark, path)
    if not groups:
        raise ValueError(f"{path} holds no line")
    names = groups[0][0]
    df = _typed(groups, spark, [T.StructField(n, T.DoubleType()) for n in names], "failfast", False)
    label = label or names[-1]
    return df.select(*[F.col(quoted(n)) for n in names if n != label], F.col(quoted(label)).alias("label"))


def write_predictions(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Write delimited text with a header, replacing what stands at ``path``.

    Every task writes its own file. ``single_file`` sends all rows through one task and is for small results only.
    """
    out = df.repartition(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)


def preview(df: DataFrame, key: str, rows: int = 5) -> DataFrame:
    """The first rows by ``key``: a repeatable preview (top-k, no full sort)."""
    return df.orderBy(key).limit(rows)
