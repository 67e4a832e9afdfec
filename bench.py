"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from keepwell.plans.catalog import QUERIES
from keepwell.session import local_session

HEADLINE = [
    "customer_snapshot",
    "tx_features_overall",
    "tx_features_latest",
    "churn_by_latest_auto_renewal",
    "churn_by_payment_recency",
    "churn_by_transaction_frequency",
    "churn_by_profile_availability",
    "model_input",
    "stratified_split_exact",
    "split_roles",
    "numeric_medians",
    "scaled_features",
    "ordinal_features",
    "ranking_curve",
    "roc_auc",
    "model_metrics",
    "calibration_table",
    "isotonic_calibration",
    "champion_selection",
    "scored_with_value",
    "campaign_priority_list",
    "campaign_sensitivity",
    "campaign_spend_grid",
    "campaign_recommendation",
    "dq_contracts",
    "driver_feed_labels",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "*"), "bench")
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["churn_by_latest_auto_renewal"](spark, sf_dir).collect()  # start-up is not a query
    seconds = {}
    for name in HEADLINE:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
