"""Run a whole job: ``spark-submit … -m arborlog`` or ``python -m arborlog``.

Everything a job finds is written, whole, beside its output: metrics, importances, rules and search table, or terms and report.
What is shown is a first look only.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from arborlog.plans.fraud import run_fraud_file
from arborlog.plans.trips import run_trip_files
from arborlog.sources.delimited import preview, read_delimited, write_predictions


def beside(output: str, name: str) -> str:
    """Where a table of a job is written: next to its output folder."""
    return f"{output.rstrip('/')}-{name}"


def main() -> None:
    parser = argparse.ArgumentParser(prog="arborlog")
    jobs = parser.add_subparsers(dest="job", required=True)
    trips = jobs.add_parser("trips", help="trip durations by a regression tree")
    trips.add_argument("train")
    trips.add_argument("test")
    trips.add_argument("output")
    trips.add_argument("--tree", choices=["binned", "categorical", "exact"], default="binned")
    trips.add_argument("--single-file", action="store_true", help="write one file through one task (small results only)")
    trips.add_argument(
        "--handle-invalid", choices=["keep", "skip", "error"], default="keep", help="what a missing value in a test trip does"
    )
    fraud = jobs.add_parser("fraud", help="card fraud by logistic regression")
    fraud.add_argument("path")
    fraud.add_argument("output", help="folder for the terms and the report")
    fraud.add_argument("--solver", choices=["lbfgs", "gd"], default="lbfgs")
    fraud.add_argument("--scale", action="store_true", help="z-score the features first")
    args = parser.parse_args()

    # Above 8,000 bytes the JVM does not compile a generated method; let the planner split such stages.
    builder = SparkSession.builder.appName(f"arborlog-{args.job}").config("spark.sql.codegen.hugeMethodLimit", "8000")
    spark = builder.getOrCreate()
    if args.job == "trips":
        result = run_trip_files(spark, args.train, args.test, args.output, args.tree, args.single_file, args.handle_invalid)
        tables = {"metrics": result.metrics, "importance": result.importance, "rules": result.rules, "search": result.search}
        for name, table in tables.items():
            if table is not None:
                write_predictions(table, beside(args.output, name))
        result.metrics.show(truncate=False)
        preview(read_delimited(spark, args.output), "id").show()
    else:
        result = run_fraud_file(spark, args.path, args.solver, args.scale)
        write_predictions(result.model.terms(spark), beside(args.output, "terms"))
        write_predictions(result.report, beside(args.output, "report"))
        result.report.orderBy("split", "metric", "label").show(truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
