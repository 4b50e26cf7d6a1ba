"""Headline queries at BENCH_SF_DIR on local[BENCH_CPUS]; prints one JSON line.

Every query is run to the last row into a sink that discards them. The time is
the median of three runs after two warm-up runs; queries that train models run
once after one warm-up run. BENCH_QUERIES restricts the run to some names, comma-separated.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from checks.queries import QUERIES  # noqa: E402

RELATIONAL = [
    "product_star_profile_lineitem",
    "user_star_profile_lineitem",
    "full_outer_merge",
    "attach_profiles_lineitem",
    "user_review_rate_orders",
    "user_review_rate_events",
    "top_reviewers_by_rate_orders",
    "attach_profiles",
    "text_shape",
    "feature_table",
    "features_as_text",
    "normalize_text",
    "normalize_text_lemmas",
    "term_counts",
    "document_frequency",
    "tfidf_terms",
    "random_split",
    "contiguous_index_lineitem",
    "string_index",
    "nb_aggregates",
    "nb_predict",
    "nb_cv_relational",
    "string_index_applied",
    "classification_metrics",
    "wssse",
]
TRAINED = [
    "nb_train_eval",
    "kmeans_train_eval",
    "rf_train_eval",
    "lsvc_train_eval",
    "mlp_train_eval",
    "nb_cv",
    "read_line_corpus",
]


def run_once(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    # Tables that queries write live as long as this run.
    with tempfile.TemporaryDirectory(prefix="reviewlens-bench-") as shared:
        measure(sf_dir, cpus, chosen, shared)


def measure(sf_dir: str, cpus: str, chosen: str | None, shared: str) -> None:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("reviewlens-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.checkpoint.dir", shared)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    timings: dict[str, float] = {}
    for name in chosen.split(",") if chosen else RELATIONAL + TRAINED:
        runs = [run_once(spark, name, sf_dir) for _ in range(2 if name in TRAINED else 5)]
        timings[name] = round(statistics.median(runs[2:] or runs[1:]), 3)
        print(f"{name}: {timings[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total wall time of headline queries",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
