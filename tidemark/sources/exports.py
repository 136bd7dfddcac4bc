"""Sorted export of any size: ordered files with a manifest, no task holds all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from tidemark.sources.csv import all_string_schema

PART = "__part"


def write_sorted_csv(df: DataFrame, path: str, sort_by: Sequence[str], parts: int) -> DataFrame:
    """Overwrite ``path`` with ``df`` as CSV files in order, and return their manifest.

    The manifest has ``part, rows, first_row`` and is also written, to
    ``<path>_manifest``. The files of folder ``__part=0``, of ``__part=1`` and so
    on, one after another, are ``df`` in the order of ``sort_by`` (NULLs first). Spark
    samples the keys for range borders, so a part holds about its share of the
    rows. Rows that agree in all of ``sort_by`` share a part: where a value is
    frequent, sort by further columns too.
    """
    order = [F.col(c).asc_nulls_first() for c in sort_by]
    ranged = df.repartitionByRange(parts, *order).withColumn(PART, F.spark_partition_id()).sortWithinPartitions(PART, *order)
    base = path.rstrip("/")
    counted = Observation(f"export {base}")
    keeps = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    ranged.observe(counted, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").option("header", "true").options(**keeps).partitionBy(PART).csv(base)
    spark = df.sparkSession
    written = spark.read.schema(all_string_schema(df.columns).add(PART, IntegerType())).option("header", "true").csv(base)
    counts = written.groupBy(F.col(PART).alias("part")).agg(F.count(F.lit(1)).alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # over a row a part
    manifest = counts.select("part", "rows", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first_row"))
    manifest.coalesce(1).write.mode("overwrite").parquet(f"{base}_manifest")
    manifest = spark.read.parquet(f"{base}_manifest")
    total = manifest.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    if total != counted.get["rows"]:
        raise RuntimeError(f"{base}: {counted.get['rows']} rows were written and {total} are read back")
    return manifest
