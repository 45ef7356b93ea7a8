"""Times headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query is planned, run and fully materialised (noop sink). Shared tables
(snapshot, split, prepared features) are timed under their own names.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from churnspark.plans import workspace as W  # noqa: E402
from churnspark.plans.catalog import QUERIES  # noqa: E402
from churnspark.session import build_session  # noqa: E402

HEADLINE = (
    "scan_customers", "table_fingerprint", "dup_rows", "null_profile", "value_share",
    "describe_numeric", "distinct_counts", "target_by_split", "kpi_overview",
    "churn_rate_by_credit", "churn_rate_top_regions", "histogram_by_class", "corr_with_target",
    "corr_matrix", "stratified_split", "rare_to_other", "impute_median", "robust_scale",
    "clip_bounds", "prepared_features", "metrics_long", "metrics_pivot", "roc_auc", "roc_curve",
    "gain_curve", "gain_at_pct", "threshold_sweep", "assign_segment", "segment_index",
    "segment_churn", "silhouette_sample", "seeded_sample", "action_lookup", "logistic_scores",
    "tree_scores",
)
# The expensive ones, apart from the names above so that rounds can be compared.
HEAVY = (
    "boosting_scores", "forest_scores", "model_metrics", "kmeans_segments", "k_scan",
    "pca_projection", "score_customers", "what_if", "score_stream", "permutation_importance",
    "boosting_rounds", "boosting_certificate", "forest_certificate", "kmeans_certificate",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(cpus, int(cpus))
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()  # start the engine
    times: dict[str, float] = {}

    def timed(name, run) -> None:
        start = time.perf_counter()
        run()
        times[name] = round(time.perf_counter() - start, 3)

    timed("build_snapshot", lambda: W.snapshot(spark, sf_dir))
    timed("build_split", lambda: W.split_path(spark, sf_dir))
    timed("build_prepared", lambda: W.prepared(spark, sf_dir))
    for name in (*HEADLINE, *HEAVY):
        timed(name, lambda: QUERIES[name](spark, sf_dir).write.format("noop")
              .mode("overwrite").save())
    builds = sum(v for k, v in times.items() if k.startswith("build_"))
    print(json.dumps({"metric": "total_time", "value": round(sum(times.values()), 3),
                      "unit": "sec", "build": round(builds, 3),
                      "heavy": round(sum(times[k] for k in HEAVY), 3),
                      "queries": times, "sf": os.path.basename(sf_dir)}))
    spark.stop()


if __name__ == "__main__":
    main()
