"""Headline queries at BENCH_SF_DIR on local[BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from adoptrend.plans.catalog import QUERIES
from adoptrend.session import build_session

HEADLINE = [
    "monthly_metrics",
    "enriched_activity",
    "growth_features",
    "emergence_rank",
    "mine_pairs",
    "migration_edges",
    "co_edges",
    "pagerank_undirected",
    "connected_components",
    "communities",
    "community_orgs",
    "gapfilled_series",
    "forecast_rows",
    "cluster_languages",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", "bench", **{"spark.sql.shuffle.partitions": cpus})
    spark.range(1000).selectExpr("sum(id)").collect()  # the first job pays for the start of the engine
    took = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total time of headline queries",
                "value": round(sum(took.values()), 3),
                "unit": "sec",
                "queries": took,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
