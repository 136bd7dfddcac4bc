"""Benchmark: end-to-end pipeline plus every registered query.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Prints ONE JSON line:
  {"metric": "pipeline_wall", "value": <sec>, "unit": "sec", "queries": {...}, "sf": ...}

``value`` is the wall time of the whole layered pipeline (raw -> store ->
publish -> analysis written as Parquet, plus CSV exports), the job the
reference times. ``queries`` holds per-query wall times, each executed in
full through the ``noop`` sink (no collect to the driver).
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    from tidemark.plans.pipeline import run
    from tidemark.plans.registry import QUERIES
    from tidemark.session import local_session
    from tidemark.sources.layers import Layout, shared_base
    from tidemark.sources.tpch_roles import raw_tables

    t0 = time.time()
    work = os.environ.get("BENCH_WORK_DIR") or tempfile.mkdtemp(prefix="tidemark-bench-")
    spark = local_session("tidemark-bench", cores=cpus, checkpoint_dir=f"file://{work}")
    startup = time.time() - t0

    base = shared_base(spark, f"tidemark-bench-{uuid.uuid4().hex[:8]}")
    t0 = time.time()
    result = run(spark, raw_tables(spark, sf_dir), Layout(f"{base}/layers"), export_dir=f"{base}/exports")
    pipeline = time.time() - t0

    times: dict[str, float] = {}
    for name, q in QUERIES.items():
        t0 = time.time()
        q(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)

    print(
        json.dumps(
            {
                "metric": "pipeline_wall",
                "value": round(pipeline, 3),
                "unit": "sec",
                "queries": times,
                "queries_total": round(sum(times.values()), 3),
                "session_start": round(startup, 3),
                "pipeline_steps": result.seconds,
                "lines": result.rows.get("publish_orders"),
                "lines_per_sec": round(result.rows.get("publish_orders", 0) / pipeline, 1),
                "sf": sf,
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
