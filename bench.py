"""Times the headline queries and prints one JSON line.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (local cores), BENCH_COPIES (the events
are taken so often for the sink measurement; default 10).

Each query runs twice; the second, warm run counts.  ``events_per_sec`` is what the
published baseline measures: lines to events, written as the 33-column table and as JSON
lines, once warm.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from rampart import normalize
from rampart.functions.session import fresh_path
from rampart.plans import edges  # noqa: F401 - registers queries
from rampart.plans.lines import lines
from rampart.plans.queries import QUERIES
from rampart.sinks.writers import write_jsonl, write_lake

HEADLINE = [
    "classify_histogram",
    "vendor_action_summary",
    "telemetry_grouping_sets",
    "parser_report",
    "lake_flatten",
    "feature_matrix",
    "risk_score",
    "export_siem",
    "ioc_join",
    "geo_range_join",
    "forensic_search_topk",
    "stream_normalize",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    copies = int(os.environ.get("BENCH_COPIES", "10"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds, cold = {}, {}
    for name in HEADLINE:
        for taken in (cold, seconds):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken[name] = round(time.perf_counter() - start, 3)
    source = lines(spark, sf_dir, int(cpus))
    many = source.select(F.explode(F.sequence(F.lit(1), F.lit(copies))), "raw_event").drop("col")
    count = many.count()
    start = time.perf_counter()
    write_lake(normalize(many), fresh_path(spark, "bench-lake"))
    write_jsonl(normalize(many), fresh_path(spark, "bench-jsonl"))
    sinks = time.perf_counter() - start
    print(
        json.dumps(
            {
                "metric": "headline_total_warm",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "cold_queries": cold,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "events": count,
                "both_sinks_sec": round(sinks, 3),
                "events_per_sec": round(count / sinks, 1),
                "events_per_sec_per_core": round(count / sinks / int(cpus), 1),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
