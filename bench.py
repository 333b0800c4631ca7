"""Time the headline queries; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [query ...]
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from saleslens.registry import QUERIES
from saleslens.session import build_session

HEADLINE = [
    "agg_items_per_order", "agg_orders_daily", "agg_quantile", "join_skeleton_left_chain", "win_row_number", "win_rolling_row",
    "feat_hist_rolling", "feat_promo_intensity", "dq_report",
    "an_yearly_kpis", "an_revenue_concentration", "an_channel_metrics", "an_cohort_retention", "an_new_vs_repeat",
    "an_margin_erosion", "an_region_share", "an_campaign_effect", "an_campaign_tiered_baseline", "an_discount_depth_margin",
    "an_promo_retention", "an_promo_stats", "an_net_clv", "an_stockout_lost_revenue", "an_quadrant", "an_reason_mix",
    "fc_seasonal_naive", "fc_metrics", "fc_trend_ridge",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g",
           "spark.ui.showConsoleProgress": "false", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-")})
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    run(spark, "agg_count_by_key", folder)  # start-up cost of the session is not a query's cost
    # The smaller of two runs: the first also compiles code, and the machine may be busy.
    seconds = {n: round(min(run(spark, n, folder) for _ in range(2)), 3) for n in names}
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "cpus": int(cpus)}))


def run(spark, name: str, folder: str) -> float:
    """Seconds to build and fully execute a query; every result row is produced."""
    t0 = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


if __name__ == "__main__":
    main()
