"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores, ``BENCH_RUNS`` the
timed runs per batch query (after one warm-up; the median counts). Streams are timed
once, from an empty checkpoint to the end of their input, after a run on the smallest tables.
The queries named ``in_chunks`` and ``by_type`` take the path of hot keys, which the size of
these tables would not.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from millrace.catalog import REGISTRY
from millrace.session import build_session

BATCH = """q_tumble q_slide q_session q_window_all q_window_reduce q_window_process
q_count_tumble q_count_slide q_topn_two_phase q_wordcount_batch q_wordcount_running
q_lateral_cross q_connect_join q_window_join q_interval_join q_interval_join_late
q_broadcast_threshold q_running_max q_running_maxby q_state_running_avg q_state_top3
q_state_jump_alert q_state_ttl q_state_value_counts q_changelog_sum q_running_watermark
q_late_side_output q_allowed_lateness q_idle_source_watermark q_udtaf_top2_grouped
q_udaf_weighted_avg q_udf_java_hash
q_session_in_chunks q_running_watermark_in_chunks q_allowed_lateness_in_chunks q_state_top3_in_chunks
q_window_process_in_chunks q_state_running_sum_by_type""".split()
STREAMS = "q_tumble_stream q_wordcount_stream q_state_jump_alert_stream".split()
#: Streams run once here before they are timed: compiled code, started workers.
SMALL = "/root/testdata/sf0.001"


def run(name: str, spark: object, sf_dir: str) -> float:
    start = time.perf_counter()
    REGISTRY[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = sys.argv[1:]
    spark = build_session(
        f"local[{cpus}]",
        "millrace-bench",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    took = {}
    for name in BATCH:
        if not only or name in only:
            run(name, spark, sf_dir)
            took[name] = statistics.median(run(name, spark, sf_dir) for _ in range(runs))
    for name in STREAMS:
        if not only or name in only:
            if os.path.isdir(SMALL):
                run(name, spark, SMALL)
            took[name] = run(name, spark, sf_dir)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(took.values()), 3),
                "unit": "sec",
                "queries": {name: round(seconds, 3) for name, seconds in took.items()},
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
