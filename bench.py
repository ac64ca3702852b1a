"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR names the folder of Parquet tables, BENCH_CPUS the local cores.
Each query runs in full and its result is consumed by a sink that discards it.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from orderlore.plans import registry  # noqa: E402

HEADLINES = [
    "latest_reminder",
    "unpacked_deltas",
    "subscription_cancel_rank",
    "classification_fanout",
    "cancel_classification",
    "orders_general_info",
    "orders_recency_info",
    "feature_matrix_train",
    "feature_matrix_train_window",
    "feature_matrix_predict",
    "feature_matrix_segments",
    "segment_matrix",
    "standardize",
    "roc_auc",
    "train_gbt",
    "score_orders",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("orderlore-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    every = {**registry.DATA_QUERIES, **registry.PREP_QUERIES, **registry.MODEL_QUERIES}
    seconds: dict[str, float] = {}

    def timed(name: str, run) -> None:
        began = time.perf_counter()
        run()
        seconds[name] = round(time.perf_counter() - began, 3)

    # derived inputs, written once: tables, classification, matrices, the final model
    timed("derive_tables", lambda: dict(registry.tables_of(spark, folder)))
    timed("store_classification", lambda: registry.classified_of(spark, folder))
    timed("store_matrices", lambda: registry.store_matrices(spark, folder))
    timed("fit_final_model", lambda: registry.final_model(spark, folder))
    for name in HEADLINES:
        timed(name, lambda: every[name](spark, folder).write.format("noop").mode("overwrite").save())
    scale = Path(folder).name.removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
