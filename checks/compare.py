"""Run queries next to their SQL and compare the rows: ``python -m checks.compare [folder] [query …]``."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.queries import QUERIES
from checks.sql import ORACLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _key(row: tuple) -> tuple:
    return tuple((v is None, str(type(v).__name__), repr(v) if isinstance(v, (bool, str)) else v) if v is not None else (True, "", 0) for v in row)


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs: column names, row count or values (no order, no tolerance)."""
    names = sorted(df.columns)
    got = sorted((tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect()), key=_key)
    found = con.execute(f"SELECT {', '.join(chr(34) + n + chr(34) for n in names)} FROM ({sql})")
    expected = sorted(found.fetchall(), key=_key)
    columns = sorted(d[0] for d in con.execute(f"SELECT * FROM ({sql}) LIMIT 0").description)
    out = []
    if columns != names:
        out.append(f"columns {names} against {columns}")
    if len(got) != len(expected):
        out.append(f"{len(got)} rows against {len(expected)}")
    types = [(a, b) for a, b in zip((type(v) for v in got[0]), (type(v) for v in expected[0]))] if got and expected else []
    out += [f"type of {n}: {a} against {b}" for n, (a, b) in zip(names, types) if a is not b and type(None) not in (a, b)]

    def same(a, b) -> bool:
        return a == b or (isinstance(a, float) and isinstance(b, float) and math.isnan(a) and math.isnan(b))

    wrong = [(g, e) for g, e in zip(got, expected) if not all(map(same, g, e))]
    if wrong:
        out.append(f"{len(wrong)} rows differ, first {wrong[0]}")
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in wanted:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            if name in ORACLES:
                found = differences(df, con, ORACLES[name])
                verdict = "same" if not found else "DIFFERENT " + "; ".join(found)
            else:
                found, verdict = [], f"{len(df.collect())} rows (no SQL)"
        except Exception as e:  # report and go on with the next query
            found, verdict = [e], "FAILED " + str(e).strip()[:600]
        failed += bool(found)
        print(f"{name:24} {time.time() - start:6.1f}s {verdict}", flush=True)
    print(f"{failed} of {len(wanted)} not right")
    sys.exit(bool(failed))


if __name__ == "__main__":
    main()
