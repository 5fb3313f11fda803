"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1) and ``BENCH_CPUS`` (default 8)
choose the data and the cores. Every query is computed in full into Spark's noop
sink: all of them once to warm up, then each ``BENCH_RUNS`` (default 3) times; the
best time counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

from supplyview.plans.queries import QUERIES
from supplyview.session import local_session

HEADLINE = (
    "pivot_totals", "enhanced_pivot", "enhanced_pivot_fuzzy", "ingredient_map_fuzzy",
    "combined_fact", "category_counts", "new_products", "projection_risk",
    "header_strict", "promote_header", "split_markers", "table_boundaries",
    "null_pattern_segments", "ffill_all", "delivery_fact", "split_tables",
    "inventory_table", "partition_status", "advanced_split", "grid_profile",
    "table_boundaries_legacy",
)


def timed(spark, sf_dir: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "supplyview-bench")
    spark.sparkContext.setLogLevel("ERROR")
    for name in names:
        timed(spark, sf_dir, name)
    queries = {}
    for name in names:
        queries[name] = round(min(timed(spark, sf_dir, name) for _ in range(runs)), 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(queries.values()), 3),
        "unit": "sec",
        "queries": queries,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
