"""Session helpers for local runs (tests, bench, checks).

On a cluster the caller owns the session; the library only reads settings
from it. Locally we pin what the operators assume: UTC session time zone
(wall-clock timestamps are used throughout anyway), adaptive execution with
skew-join splitting, and no generated method longer than the JVM compiles. Callers that write layers name their checkpoint folder.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(
    app: str = "tidemark",
    cores: "int | str" = "*",
    shuffle_partitions: "int | None" = None,
    checkpoint_dir: "str | None" = None,
) -> SparkSession:
    n = (os.cpu_count() or 8) if cores == "*" else int(cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or max(8, 2 * n)))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # the JVM leaves methods over 8000 bytes of code to its interpreter; Spark then plans without one large method
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.driver.memory", os.environ.get("TIDEMARK_DRIVER_MEMORY", "8g"))
    )
    if checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
