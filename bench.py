"""Time headline queries and print one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the number of cores, ``BENCH_RUNS`` the
timed runs per query (the best one counts). Results are consumed in full and thrown away.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tidelog.catalog import REGISTRY
from tidelog.session import build_session

QUERIES = [
    "page_views_by_region", "filter_rows", "branch", "route_topic", "group_count", "word_count_ascii",
    "word_count_unicode", "running_count", "latest_by_key", "table_regroup_count", "moving_average",
    "top_n_per_group", "top_n_windowed", "cms_count", "tumbling_count", "hopping_count",
    "hopping_count_dense", "session_count", "sessionize", "late_split", "interval_join",
    "interval_outer_join", "table_table_changelog", "stream_table_join", "global_table_join",
    "dedup_window", "fraud_check", "inventory_reserve", "validation_aggregate", "wiki_parse",
    "cep_strict", "cep_skip_next", "cep_skip_any", "cep_kleene", "cep_fold", "composite_event",
    "time_weighted_moments", "value_stdev", "sliding_sum", "size_batches",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "bench", f"local[{cpus}]", int(cpus),
        {"spark.ui.enabled": "false", "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("OFF")
    REGISTRY["group_count"](spark, sf_dir).count()
    seconds: dict[str, float] = {}
    for name in sys.argv[1:] or QUERIES:
        best = None
        for _ in range(runs):
            began = time.perf_counter()
            REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - began
            best = took if best is None else min(best, took)
        seconds[name] = round(best, 3)
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
