"""Time the headline queries; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [name ...]

A query's time covers building it (fits run then) and computing all its rows. After BENCH_LIMIT seconds no further query
is started; if the run is ended, the line holds what was measured until then.
"""

from __future__ import annotations

import json
import os
import signal
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from classkit.plans import QUERIES  # noqa: E402

HEADLINE = [
    "stratified_split_lines",
    "nested_split",
    "stratified_folds",
    "apply_scaler",
    "fit_fold_scalers",
    "knn_report",
    "knn_k_grid",
    "knn_selected_scores",
    "classification_report",
    "confusion_matrix",
    "roc_auc",
    "average_precision",
    "model_comparison",
    "cross_validation_summary",
    "edge_styles",
    "robust_maximum",
    "early_stop",
    "mlp_forward",
    "mlp_gradient",
    "mlp_loss_curve",
    "mlp_cross_validation",
    "mlp_early_stop_history",
    "knn_vs_mlp",
    "boosting_best_split",
    "boosted_binary_report",
    "boosted_multiclass_report",
]


LIMIT = float(os.environ.get("BENCH_LIMIT", "1200"))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("classkit-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Start the JVM's and Python's workers outside the clock.
    spark.range(1000).mapInArrow(lambda batches: batches, "id long").count()
    times, begun, sf = {}, time.perf_counter(), os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")

    def report() -> None:
        total = round(sum(times.values()), 3)
        print(json.dumps({"metric": "headline queries, total time", "value": total, "unit": "sec", "queries": times, "sf": sf}), flush=True)

    def ended(*_) -> None:
        report()
        os._exit(1)

    signal.signal(signal.SIGTERM, ended)
    for name in sys.argv[1:] or HEADLINE:
        if time.perf_counter() - begun > LIMIT:
            print(f"not started within {LIMIT} s: {name}", file=sys.stderr)
            continue
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(json.dumps({name: times[name]}), file=sys.stderr, flush=True)
    report()
    spark.stop()


if __name__ == "__main__":
    main()
