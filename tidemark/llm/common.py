"""Shared helpers: working tables in the session's checkpoint folder, row keys, Arrow slices."""

from __future__ import annotations

import hashlib
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows handled at once inside a Python task; long texts make small slices anyway.
SLICE_ROWS = 256


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once for each Spark application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    sources = sorted(root.rglob("*.py"))
    digest = hashlib.sha256(b"".join(p.read_bytes() for p in sources)).hexdigest()[:16]
    archive = Path(tempfile.mkdtemp(prefix="tidemark-")) / f"tidemark-{digest}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for p in sources:
            out.write(p, p.relative_to(root.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def work_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; a temporary one is set where a local session has none."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="tidemark-work-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{work_folder(spark)}/tidemark-{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage is cut, and lost executors cost no rerun."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_hash(column: Column | str) -> Column:
    """64 bits that tell rows of one id apart; null counts as empty."""
    column = F.col(column) if isinstance(column, str) else column
    return F.xxhash64(F.coalesce(column, F.lit("")))


def slices(batch: pa.RecordBatch, rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)
