"""Headline-query benchmark.

Runs the registered headline queries over ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) on ``local[$BENCH_CPUS]`` and prints one JSON line.
Each query is run to completion through the ``noop`` sink (every column of
every row computed, nothing collected).  Set ``BENCH_EVENT_LOG_DIR`` to a
scratch folder to get Spark's event log (stage and task times).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "canonical_results",
    "fastest_per_race",
    "avg_final_by_sex",
    "swimmers_per_race_top10",
    "avg_final_per_race",
    "parse_sheets",
    "results_table",
    "prepared",
    "document_lines",
    "document_noise",
    "page_anchor_links",
    "link_table",
    "ingest_resumed",
    "correlation_matrix",
    "final_time_histogram",
    "feature_importances",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from lapline.plans.registry import REGISTRY
    from lapline.session import local_session
    from lapline.sources.tables import INPUT_PARTITIONS
    spark = local_session(cpus=cpus, shuffle_partitions=cpus * 2, app="lapline-bench",
                          event_log_dir=os.environ.get("BENCH_EVENT_LOG_DIR"))
    # the bench tables are one file of one row group each: deal them over the cores
    spark.conf.set(INPUT_PARTITIONS, str(cpus))
    # warm the JVM and the file listing once (not timed)
    spark.read.parquet(f"{sf_dir}/region.parquet").count()
    names = sys.argv[1:] or HEADLINE
    times = {}
    for name in names:
        t0 = time.time()
        REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
