"""Stage times of one registered query, from Spark's event log.

Usage: python tools/stage_times.py QUERY [sf_dir] [--warm]

Writes the event log to a fresh scratch folder (no UI, no server) and prints,
per completed stage: wall time, tasks, summed task time, input rows, shuffle
read/write bytes. With ``--warm`` the query runs twice and only the second run
is reported, so one-time costs (JVM warm-up, code generation) drop out.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

GROUP = "tidemark-measured"


def main() -> None:
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    warm = "--warm" in sys.argv[1:]
    name = args[0]
    sf_dir = args[1] if len(args) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="tidemark-events-")
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(f"local[{os.environ.get('BENCH_CPUS', '8')}]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", log_dir)
        .config("spark.eventLog.compress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "16")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from tidemark.plans.registry import QUERIES

    if warm:
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.sparkContext.setJobGroup(GROUP, name)
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.stop()

    events = []
    for path in glob.glob(os.path.join(log_dir, "**", "events_*"), recursive=True):
        with open(path) as f:
            events += [json.loads(line) for line in f]
    measured = set()
    for ev in events:
        if ev.get("Event") == "SparkListenerJobStart" and ev.get("Properties", {}).get("spark.jobGroup.id") == GROUP:
            measured.update(ev.get("Stage IDs", []))
    for ev in events:
        if ev.get("Event") != "SparkListenerStageCompleted":
            continue
        info = ev["Stage Info"]
        if info["Stage ID"] not in measured:
            continue
        acc = {a.get("Name"): a.get("Value") for a in info.get("Accumulables", [])}
        shuffle_read = acc.get("internal.metrics.shuffle.read.remoteBytesRead", 0) + acc.get(
            "internal.metrics.shuffle.read.localBytesRead", 0
        )
        print(
            f"stage {info['Stage ID']:>3} {info['Completion Time'] - info['Submission Time']:>6} ms "
            f"tasks {info['Number of Tasks']:>3} task_ms {acc.get('internal.metrics.executorRunTime', 0):>6} "
            f"in_rows {acc.get('internal.metrics.input.recordsRead', 0):>8} shuffle_read {shuffle_read:>9} "
            f"shuffle_write {acc.get('internal.metrics.shuffle.write.bytesWritten', 0):>9}"
        )
    print("event log:", log_dir)


if __name__ == "__main__":
    main()
