"""The operators on many copies of lineitem, a third of whose rows share one key.

    python benchmarks/scale.py [copies]

Builds the copies with Spark in a scratch folder, runs each step once and reads task
times from Spark's event log. Prints a JSON line per step, and one per stage that reads
a tenth of the rows or more: how its slowest and largest tasks compare with the median.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from collections import defaultdict
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import functions as F  # noqa: E402

from tablesync import (  # noqa: E402
    anti_join, count_new, flag_restricted, load_table, local_session, newer_than, prepare_list, read_target, read_watermark, stage,
)

HOT = 7
MARK = "2000-01-01 00:00:00"
READ_METRICS = (("Input Metrics", "Records Read"), ("Shuffle Read Metrics", "Total Records Read"))


def build(spark, copies: int, path: str):
    lines = spark.read.parquet(f"{os.environ.get('BENCH_SF_DIR', '/root/testdata/sf0.1')}/lineitem.parquet")
    copied = lines.repartition(copies).withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    key = F.when(F.col("l_linenumber") % 3 == 0, HOT).when(F.col("l_quantity") > 45, None)
    rows = copied.select(
        key.otherwise(F.col("l_orderkey") * copies + F.col("copy")).alias("key"), "copy", *lines.columns
    )
    rows.write.parquet(path)
    return spark.read.parquet(path)


def task_times(log_dir: str) -> dict[str, dict[int, list[tuple[float, int]]]]:
    """Seconds and rows read, per step (job group), stage and task."""
    groups, times = {}, defaultdict(lambda: defaultdict(list))
    for file in Path(log_dir).rglob("*"):
        if not file.is_file() or file.name.startswith((".", "appstatus")):
            continue
        for line in file.open():
            event = json.loads(line)
            if event["Event"] == "SparkListenerJobStart":
                for stage_id in event["Stage IDs"]:
                    groups[stage_id] = event.get("Properties", {}).get("spark.jobGroup.id", "")
            elif event["Event"] == "SparkListenerTaskEnd" and event["Stage ID"] in groups:
                info = event["Task Info"]
                metrics = event.get("Task Metrics") or {}
                rows = sum(metrics.get(k, {}).get(n, 0) for k, n in READ_METRICS)
                task = ((info["Finish Time"] - info["Launch Time"]) / 1000, rows)
                times[groups[event["Stage ID"]]][event["Stage ID"]].append(task)
    return times


def main() -> None:
    copies = int(sys.argv[1]) if len(sys.argv) > 1 else 20
    scratch = tempfile.mkdtemp(prefix="scale-", dir="/tmp")
    os.mkdir(f"{scratch}/events")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), **{
        "spark.checkpoint.dir": f"{scratch}/checkpoints",
        "spark.eventLog.enabled": "true",
        "spark.eventLog.dir": f"file:{scratch}/events",
        "spark.eventLog.compress": "false",
        "spark.sql.shuffle.partitions": "64",
        # thresholds of the skew handling, in proportion to the trial's data
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8m",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    rows = build(spark, copies, f"{scratch}/lines")
    half = rows.where("key % 2 = 0 OR key = 7").select(F.col("key").alias("rid"))
    target = f"{scratch}/target"

    def noop(df):
        df.write.format("noop").mode("overwrite").save()

    steps = {
        "watermark": lambda: read_watermark(rows, "l_shipdate"),
        "count_new": lambda: count_new(rows, "l_shipdate", MARK).first()[0],
        "extract": lambda: noop(newer_than(rows, "l_shipdate", MARK)),
        "prepare_list": lambda: prepare_list(half, "rid").n_bytes,
        "anti_join_broadcast": lambda: noop(anti_join(rows, half, "key", "rid", limit=1 << 40)),
        "anti_join_shuffled": lambda: noop(anti_join(rows, half, "key", "rid", limit=0)),
        "flag_shuffled": lambda: noop(flag_restricted(rows, half, "key", "rid", normalise="plain", limit=0)),
        "load_append": lambda: load_table(rows, target, "append").rows_written,
        "load_truncate": lambda: load_table(newer_than(read_target(spark, target), "l_shipdate", MARK), target, "truncate").rows_written,
        "stage_by_hot_value": lambda: stage(rows.withColumn("hot", F.col("key") == HOT), f"{scratch}/staged", "hot"),
    }
    seconds, values = {}, {}
    for name, step in steps.items():
        spark.sparkContext.setJobGroup(name, name)
        start = time.perf_counter()
        values[name] = step()
        seconds[name] = round(time.perf_counter() - start, 2)
    total = rows.count()
    spark.stop()
    times = task_times(f"{scratch}/events")
    print(json.dumps({"rows": total, "copies": copies, "scratch": scratch}))
    for name in steps:
        print(json.dumps({"step": name, "seconds": seconds[name], "value": str(values[name])}))
        for stage_id, tasks in sorted(times.get(name, {}).items()):
            spans, rows_read = zip(*tasks)
            if sum(rows_read) > total / 10:
                print(json.dumps({
                    "step": name, "stage": stage_id, "tasks": len(tasks),
                    "median_seconds": round(statistics.median(spans), 3), "slowest_seconds": round(max(spans), 3),
                    "median_rows": int(statistics.median(rows_read)), "largest_rows": max(rows_read),
                }))


if __name__ == "__main__":
    main()
