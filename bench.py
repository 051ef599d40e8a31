"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerwave.plans.catalog import QUERIES  # noqa: E402
from ledgerwave.session import local_session  # noqa: E402

HEADLINE = (
    "arr_bridge_by_period",
    "fct_arr",
    "arr_account_product_month",
    "fct_acv",
    "bookings_by_segment",
    "fct_usage",
    "utilization_buckets",
    "rpt_recon",
    "recon_summary",
    "dim_account",
    "derived_metric",
    "metric_by_dimension",
    "chin_index",
    "recent_vs_career_watchlist",
    "career_features_asof",
    "training_pairs",
    "round_scorecard",
    "shrink_to_global",
    "kpi_frame",
    "matchup_modifiers",
    "reasoning_text",
    "run_checks",
    "train_method",
)


def run(spark, name: str, folder: str) -> float:
    """Seconds to build a query and compute every row of it."""
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores, **{"spark.ui.showConsoleProgress": "false"})
    seconds = {}
    for name in names:
        run(spark, name, folder)
        seconds[name] = round(sorted(run(spark, name, folder) for _ in range(repeats))[repeats // 2], 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
