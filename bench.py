"""Time the headline queries: one JSON line on standard output.

``BENCH_SF_DIR`` names the folder, ``BENCH_CPUS`` the local cores; names on the command line choose other queries.
Every query is computed in full and its rows are thrown away (``noop`` sink).
"""

from __future__ import annotations

import json
import os
import sys
import time

from tidemart.plans import registry
from tidemart.session import build_session

HEADLINE = (
    "json_parse_log", "new_visitor_repair", "log_split_display", "unique_visit", "bounce", "visitor_stats",
    "visitor_by_hour", "visitor_new_old_table", "cdc_route", "cdc_prune_columns", "dim_upsert_latest", "dim_lookup",
    "order_interval_join", "order_wide", "payment_wide", "province_stats", "product_stats", "top_spu", "gmv",
    "keyword_stats_search", "keyword_stats_product", "keyword_score", "tokenize_documents", "tumbling_count",
)


def main(names: list[str]) -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    conf = {
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    spark = build_session("bench", f"local[{cpus}]", conf)
    spark.sparkContext.setLogLevel("ERROR")
    runs = {name: registry.runner(registry.QUERIES[name]) for name in names or HEADLINE}
    # start the engine before the clock runs
    spark.read.parquet(f"{folder}/nation.parquet").groupBy("n_regionkey").count().collect()

    seconds = {}
    for name, run in runs.items():
        start = time.perf_counter()
        run(spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main(sys.argv[1:])
