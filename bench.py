"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and
print one JSON line.

Each query is executed in full with the ``noop`` sink (every row is produced,
nothing is collected to the driver). Timings are wall-clock seconds per query;
``value`` is their sum. Before the clock starts, the flagship query runs once on
the smallest data set (sf0.001, when present) so JVM / code-generation warm-up is
not charged to whichever headline query happens to run first.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillcast.plans.queries import QUERIES  # noqa: E402
from tillcast.session import build_session  # noqa: E402

HEADLINE = [
    "sales_fact", "melt_daily", "gold_all_grouping_sets", "gold_daily_sales", "gold_store_performance",
    "lag_rolling_features", "calendar_lags", "calendar_rolling", "kpi_totals", "kpi_wow_growth",
    "top_products_5", "store_ranking", "category_share", "forecast_recursive_rule", "forecast_metrics_rule",
    "backtest_metrics", "kpi_summary", "quality_report", "profile_table", "product_growth",
    "forecast_gbt_metrics", "table_status",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    scratch = tempfile.mkdtemp(prefix="tillcast-bench-")
    # Local run: the checkpoint folder is ours to pick (a cluster names its own).
    spark = build_session(f"local[{cpus}]", shuffle_partitions=2 * cpus, app_name="tillcast-bench",
                          extra={"spark.checkpoint.dir": os.path.join(scratch, "ckpt"),
                                 "spark.driver.memory": "16g"})
    spark.range(1000).selectExpr("sum(id)").collect()   # JVM warm-up, untimed
    warm = "/root/testdata/sf0.001"
    if os.path.isdir(warm) and os.path.abspath(warm) != os.path.abspath(sf_dir):
        QUERIES["gold_category_sales"](spark, warm).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    failed: dict[str, str] = {}
    for name in names:
        t0 = time.perf_counter()
        try:
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        except Exception as e:  # noqa: BLE001 - a failing query is reported, not fatal
            failed[name] = f"{type(e).__name__}: {str(e)[:200]}"
            print(f"{name}: FAILED {failed[name]}", file=sys.stderr)
            continue
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"{name}: {times[name]}s", file=sys.stderr)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus,
                      **({"failed": failed} if failed else {})}))
    spark.stop()


if __name__ == "__main__":
    main()
