"""Timings of the ten analytical queries over materialised Gold, cold and warm.

Prints one JSON line. Silver is written from the test tables, Gold is built from it
by the model list, then each query runs once cold and several times warm; the
headline is the sum of the warm medians. The pipeline steps are timed once each.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from orebed.plans import analytics, models, registry  # noqa: E402
from orebed.session import build_session, work_dir  # noqa: E402
from orebed.sources.tables import staged  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "5"))
STEPS = (
    "silver_keep_latest",
    "silver_upsert",
    "envelope_roundtrip",
    "checksum",
    "contract_split",
    "dq_staging_tests",
    "q4_rfm_rank_full",
    "q10_percentile_exact",
    "lag_alert",
    "stream_bronze",
    "stream_silver",
)


def timed(action) -> tuple[float, object]:
    start = time.perf_counter()
    result = action()
    return time.perf_counter() - start, result


def gold_queries(t: dict) -> dict:
    """The ten queries under their published names; orders and items are the bucketed facts."""
    items = t["fct_order_items"]
    return {
        "fct_orders_full_scan": lambda: analytics.full_scan(t["fct_orders"]),
        "group_by_aggregation": lambda: analytics.lifetime_value_by_state(t["dim_customers"]),
        "multi_join_enrichment": lambda: analytics.revenue_by_category(
            items, t["stg_products"]
        ),
        "window_function_rfm": lambda: analytics.rfm_top(t["fct_orders"]),
        "subquery_semi_join": lambda: analytics.orders_by_state_and_category(
            t["fct_orders"],
            t["dim_customers"],
            items,
            t["stg_products"],
            registry.STATES,
            registry.CATEGORY,
        ),
        "rolling_30d_average": lambda: analytics.rolling_revenue(t["fct_orders"]),
        "string_operations_parsing": lambda: analytics.product_search(
            t["stg_products"], items, registry.SEARCH
        ),
        "pivot_distribution": lambda: analytics.category_pivot(
            items,
            t["stg_products"],
            t["fct_orders"],
            t["dim_customers"],
            registry.PIVOT,
        ),
        "star_schema_join": lambda: analytics.star_join(
            t["fct_orders"],
            t["dim_customers"],
            items,
            t["stg_products"],
            t["stg_sellers"],
        ),
        "percentile_analytics": lambda: analytics.percentiles_exact(
            t["fct_orders"], t["dim_customers"]
        ),
        "percentile_analytics_approx": lambda: analytics.percentiles_approximate(
            t["fct_orders"], t["dim_customers"]
        ),
    }


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "12g",
            "spark.log.level": "ERROR",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    silver = work_dir(spark, "bench-silver")

    def write_silver():
        for name, entity in registry.STAGED.items():
            # The test tables are single files; Silver is a table of several.
            staged(spark, SF_DIR, entity).repartition(int(CPUS)).write.parquet(f"{silver}/{name}")

    silver_seconds, _ = timed(write_silver)
    sources = {name: spark.read.parquet(f"{silver}/{name}") for name in registry.STAGED}
    gold_seconds, tables = timed(
        lambda: models.build(spark, sources, work_dir(spark, "bench-gold"), "bench")
    )

    cold, warm, rows = {}, {}, {}
    for name, make in gold_queries(tables).items():
        cold[name], result = timed(lambda: make().collect())
        rows[name] = len(result)
        warm[name] = statistics.median(timed(lambda: make().collect())[0] for _ in range(REPEATS))
    steps = {"silver_write": silver_seconds, "gold_build": gold_seconds}
    named = registry.queries()
    for name in STEPS:
        steps[name], _ = timed(
            lambda: named[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        )

    def short(values: dict) -> dict:
        return {k: round(v, 3) for k, v in values.items()}

    headline = [n for n in warm if n != "percentile_analytics_approx"]
    print(
        json.dumps(
            {
                "metric": "ten analytical queries over Gold, sum of warm medians",
                "value": round(sum(warm[n] for n in headline), 3),
                "unit": "sec",
                "queries": short(warm),
                "cold": short(cold),
                "steps": short(steps),
                "result_rows": rows,
                "input_rows": {
                    "fct_orders": tables["fct_orders"].count(),
                    "fct_order_items": tables["fct_order_items"].count(),
                },
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": int(CPUS),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
