"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]: one JSON line with seconds per query.

Each query runs once to warm up, then three times (a stream once); the median counts. Results go to Spark's no-op sink, so every row and
column is computed. Bronze and silver tables are built first, from the input files, and timed on their own
(``build_layers``, the second of two builds); silver and gold queries read them, as the jobs do. ``daily_update`` is one
run of all jobs over the last day of messages and calls, in place, on a lake of all days before.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import functions as F

from checks.queries import AS_OF, QUERIES, raw_inputs
from checks.session import session
from checks.stage import Stage, stage
from palaver.plans.lake import run_lake
from palaver.sources.scratch import scratch_dir

HEADLINE = (
    "bronze_messages", "silver_messages", "user_activity", "daily_metrics", "user_engagement", "user_features",
    "weekly_metrics", "monthly_metrics", "conversation_analytics", "dedup_latest", "merge_upsert", "quality_report",
    "stream_live_metrics",
)
RUNS = 3


def seconds(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def daily_update(spark, sf_dir: str) -> float:
    raw, root, day = raw_inputs(spark, sf_dir), scratch_dir(spark, "lake"), F.to_date(F.lit("2024-01-30"))

    def days(keep) -> dict:
        return raw | {t: raw[t].filter(keep(F.to_date("createdAt"))) for t in ("messages", "calls")}

    run_lake(spark, days(lambda d: d < day), root, AS_OF)
    return seconds(lambda: run_lake(spark, days(lambda d: d >= day), root, AS_OF, changed_since="2024-01-30"))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    Stage(spark, sf_dir).build()
    timings = {"build_layers": round(seconds(lambda: stage(spark, sf_dir).build()), 3)}
    for name in HEADLINE:
        def run() -> None:
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

        run()
        timings[name] = round(statistics.median(seconds(run) for _ in range(1 if "stream" in name else RUNS)), 3)
        print(f"{name} {timings[name]}", file=sys.stderr, flush=True)
    timings["daily_update"] = round(daily_update(spark, sf_dir), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(timings.values()), 3), "unit": "sec",
        "queries": timings, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
