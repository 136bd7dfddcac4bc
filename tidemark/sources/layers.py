"""Layered datasets (raw -> store -> publish, plus quality checks) stored as
Parquet under one base.

Writes count their rows with an ``Observation`` attached to the write itself,
so a count costs no extra job.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

LAYERS = ("raw", "store", "publish", "quality")


@dataclass(frozen=True)
class Layout:
    """Dataset locations: ``{base}/{layer}/{name}``.

    ``base`` should be a location every executor sees (a distributed file
    system or object store); :func:`shared_base` derives one from the
    session's ``spark.checkpoint.dir``.
    """

    base: str

    def path(self, layer: str, name: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"layer must be one of {LAYERS}; got {layer!r}")
        return f"{self.base.rstrip('/')}/{layer}/{name}"


def shared_base(spark: SparkSession, *parts: str) -> str:
    """A folder under the cluster's shared checkpoint folder
    (``spark.checkpoint.dir``, or the one set on the context).

    Raises if the session has none. A configured folder is taken as it is, a
    mounted ``file:`` folder too: that the executors see it is what the setting says.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.sparkContext.getCheckpointDir()
        except (NotImplementedError, AttributeError):  # e.g. Spark Connect
            root = None
    if not root:
        raise RuntimeError("no checkpoint folder: set spark.checkpoint.dir to a shared folder")
    return "/".join([root.rstrip("/"), *parts])


def write_parquet(df: DataFrame, path: str, name: str | None = None, partition_by: tuple[str, ...] = ()) -> int:
    """Overwrite ``path`` with ``df`` as Parquet and return the rows written."""
    obs = Observation(name or path.rsplit("/", 1)[-1])
    writer = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return int(obs.get["rows"])
