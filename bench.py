"""Time the headline queries and print one JSON line. An unrelated job warms the JVM; then each
query's first run counts, with all the set-up it needs.

BENCH_SF_DIR  dataset folder   (default /root/testdata/sf0.1)
BENCH_CPUS    local threads    (default 8)
"""

from __future__ import annotations

import json
import os
import time

from tarnworks.plans.catalogue import all_queries
from tarnworks.session import get_spark

HEADLINE = [
    "core_sales",
    "dedup_ranked",
    "mart_monthly",
    "mart_by_region_product_monthly",
    "mart_quality",
    "sales_by_region_product",
    "region_stats",
    "scan_pushdown",
    "reconcile_layers",
    "stream_ingest",
    "stream_incremental",
    "raw_json_landing",
    "merge_upsert",
    "delete_copy_on_write",
    "delete_merge_on_read",
    "compact_files",
    "medallion_flow",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark("tarnworks-bench", {
        "spark.master": f"local[{cpus}]",
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    seconds: dict[str, float] = {}
    spark.range(5_000_000).selectExpr("id % 1000 AS k", "id").groupBy("k").sum("id").write.format("noop").mode("overwrite").save()
    for name in HEADLINE:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
