"""Time the headline queries: one JSON line with seconds per query.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from checks.queries import QUERIES

HEADLINE = [
    "csv_roundtrip",
    "csv_inferred_reordered",
    "roc_curve",
    "join_predictions_skewed",
    "trip_features",
    "range_filter",
    "null_profile",
    "hash_split",
    "feature_moments",
    "zscore",
    "linear_score",
    "join_predictions",
    "joined_metrics",
    "class_metrics",
    "regression_metrics",
    "metric_report",
    "prefix_sums",
    "auc_rank",
    "node_stats",
    "best_split",
    "tree_exact",
    "tree_exact_documents",
    "tree_exact_log",
    "tree_exact_cells",
    "tree_exact_deep",
    "tree_exact_categorical",
    "tree_score",
    "tree_binned",
    "tree_categorical",
    "depth_search",
    "depth_search_nested",
    "gradient_step",
    "logistic_gd",
    "logistic_lbfgs",
    "lbfgs_wide",
    "trip_job_exact",
    "trip_job_binned",
    "fraud_job_descent",
    "fraud_job_library",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        # The tables are single small files; let them be cut at every row group.
        .config("spark.sql.files.openCostInBytes", "1048576")
        # Above 8,000 bytes the JVM does not compile a generated method; let the planner split such stages.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # One untimed query starts the workers and loads the classes that all queries share.
    QUERIES["regression_metrics"](spark, sf_dir).collect()

    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
