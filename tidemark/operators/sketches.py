"""Distinct counts that merge: HyperLogLog sketches by dataset and day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Base-2 logarithm of a sketch's buckets; the relative standard error is about 1.04 / sqrt(2 ** LOG_BUCKETS).
LOG_BUCKETS = 12


def standard_error(log_buckets: int = LOG_BUCKETS) -> float:
    return 1.04 / 2 ** (log_buckets / 2)


def daily_sketches(rows: DataFrame, dataset: str, day: "Column | str", key: str, log_buckets: int = LOG_BUCKETS) -> DataFrame:
    """``dataset, day, rows, null_keys, sketch`` for each day: a few kilobytes a day, whatever its rows."""
    value = F.col(key)
    return rows.groupBy((F.col(day) if isinstance(day, str) else day).alias("day")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(value.isNull()).alias("null_keys"), F.hll_sketch_agg(value, F.lit(log_buckets)).alias("sketch")
    ).select(F.lit(dataset).alias("dataset"), "day", "rows", "null_keys", "sketch")


def merged_profile(sketches: DataFrame) -> DataFrame:
    """``dataset, total_rows, null_keys, distinct_estimate, duplicate_estimate`` from daily sketches; no row is read again.

    A day may come in several rows (late files): sketches of overlapping keys
    merge as their union. ``duplicate_estimate`` is what a keep-one-per-key
    de-duplication would remove, NULL keys collapsing into one.
    """
    merged = sketches.groupBy("dataset").agg(
        F.sum("rows").alias("total_rows"), F.sum("null_keys").alias("null_keys"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_estimate")
    )
    kept = F.col("distinct_estimate") + F.when(F.col("null_keys") > 0, 1).otherwise(0)
    return merged.select("*", F.greatest(F.col("total_rows") - kept, F.lit(0)).alias("duplicate_estimate"))
