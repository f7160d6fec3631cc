"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tenura.plans import registry  # noqa: E402
from tenura.session import build_session, shared_dir  # noqa: E402

HEADLINE = (
    "avg_prob_by_department", "daily_volume", "risk_distribution", "latency_percentiles", "model_version_usage",
    "high_risk_recent", "requests_with_predictions", "retention_kept", "fk_orphans", "accuracy_over_time",
    "build_central", "profile_columns", "value_freq_split", "rate_by_category", "corr_pairs", "corr_spearman",
    "corr_kendall", "validate_rows", "check_predictions", "encode_features", "impute_median", "roc_auc",
    "average_precision", "threshold_metrics", "cv_summary", "gate_rank_predict", "knn_topk", "near_miss1", "smote",
    "smote_tomek", "clf_logreg", "clf_rf", "clf_gbt_enhanced", "score_batch", "explain_topk", "stream_daily_volume",
)


def main() -> None:
    cpus = os.environ.get("BENCH_CPUS", "8")
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = build_session(
        f"local[{cpus}]",
        "bench",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    registry.load_all()
    shared_dir(spark)
    chosen = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    registry.QUERIES["count_by_risk"](spark, folder).collect()
    seconds: dict[str, float] = {}
    for name in chosen:
        started = time.perf_counter()
        registry.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
