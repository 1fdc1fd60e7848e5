"""Times the headline queries and prints one JSON line.

The JVM is warmed up once with the flagship query. Each query then gets one warm-up run and is timed
three times into a no-op sink; the median counts. The ``rpt_*`` queries read the stored metrics table,
whose building is timed by itself as ``build_metrics_table``. ``spread`` is the largest ratio of a query's
slowest to its fastest run, so that the machine's noise can be told from a change.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from heronry.plans import all_queries  # noqa: E402
from heronry.plans.customers import build_metrics_table  # noqa: E402
from heronry.session import build_session, clear_scratch  # noqa: E402

HEADLINES = [
    "agg_customer_metrics_pct",
    "agg_customer_metrics_abs",
    "agg_region_segment",
    "agg_conversion_rate",
    "agg_salesperson_region",
    "agg_month_sum_having",
    "agg_month_category_trend",
    "agg_product_region_qty",
    "agg_store_revenue",
    "join_left_chain",
    "join_left_enrich",
    "win_topn_per_group",
    "win_running_avg",
    "win_running_sum_product",
    "win_running_sum_flag",
    "build_metrics_table",
    "rpt_top_customers",
    "rpt_churn_risk",
    "rpt_vip",
    "rpt_export",
    "keyed_merge_additive",
    "keyed_changes_apply",
    "scl_caption_text",
    "scl_weather_case",
    "sch_infer_by_name",
    "ctas_partitioned",
    "st_parse_append",
    "st_sum_by_product",
    "st_running_avg",
    "st_customer_metrics_merge",
]


def run_once(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINES
    spark = build_session(
        "heronry-bench",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            **json.loads(os.environ.get("BENCH_CONF", "{}")),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, seconds, spread = {**all_queries(), "build_metrics_table": build_metrics_table}, {}, 1.0
    for _ in range(3):
        run_once(queries[HEADLINES[0]], spark, sf_dir)
    for name in names:
        run_once(queries[name], spark, sf_dir)
        runs = [run_once(queries[name], spark, sf_dir) for _ in range(repeats)]
        seconds[name] = round(statistics.median(runs), 4)
        spread = max(spread, max(runs) / min(runs))
    clear_scratch(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total median seconds of the headline queries",
                "value": round(sum(seconds.values()), 4),
                "unit": "sec",
                "queries": seconds,
                "spread": round(spread, 2),
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
