"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]: one JSON line.

Each query is timed end to end, driver actions included, over its whole result: rows
are written to Spark's no-op sink. The best of three runs counts, after one warm-up.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from tablesync import local_session

HEADLINE = [
    "watermark_max",
    "count_new",
    "incremental_extract",
    "watermark_milli",
    "watermark_epoch_ms",
    "anti_join_plain",
    "anti_join_padded",
    "anti_join_padded_ci",
    "anti_join_ci",
    "anti_join_numeric",
    "anti_join_star",
    "anti_join_large_list",
    "restriction_flag",
    "restriction_flag_large_list",
    "incremental_restricted",
    "load_append",
    "load_truncate",
    "load_add_columns",
    "stage_partitioned",
    "incremental_append",
    "full_refresh",
    "delta_replace",
    "sync_manifest",
    "scrub_delims",
    "conform_types",
    "run_log_parse",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    scratch = tempfile.mkdtemp(prefix="bench-", dir="/tmp")
    spark = local_session(cpus, **{
        "spark.checkpoint.dir": f"{scratch}/checkpoints",
        "spark.sql.warehouse.dir": f"{scratch}/warehouse",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    from checks import QUERIES

    names = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in names:
        runs = []
        for _ in range(repeats + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs[1:]), 3)
        print(name, seconds[name], file=sys.stderr)
    print(json.dumps({
        "metric": "total_seconds_headline_queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
