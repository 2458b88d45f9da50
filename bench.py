"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (cores), BENCH_RUNS (timed runs
per query, the median counts), BENCH_QUERIES (comma-separated names or "all").
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from parley.plans.catalog import QUERIES  # noqa: E402
from parley.session import build_session  # noqa: E402

HEADLINE = [
    "gold_client_type_distribution", "gold_user_channel", "dedupe_latest", "upsert_latest", "table_diff",
    "jsonl_text_parse", "progress_log_parse", "expect_report", "event_position", "dialog_segments",
    "dialog_daily_kpis", "activity_intent", "utterance_scores", "stream_upsert_latest",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if wanted == "all" else wanted.split(",") if wanted else HEADLINE

    spark = build_session(
        "bench", f"local[{cpus}]", int(cpus) if cpus.isdigit() else None,
        **{
            "spark.checkpoint.dir": os.environ.get("BENCH_STAGING") or tempfile.mkdtemp(prefix="parley-bench-"),
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            # Small tables: the default 32 MB page per sort costs more than the sort.
            "spark.buffer.pageSize": "2m",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    timings = {}
    for name in names:
        run(name)  # warm-up
        timings[name] = round(statistics.median(run(name) for _ in range(runs)), 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
