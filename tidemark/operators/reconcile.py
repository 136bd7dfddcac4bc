"""Reconciliation of two tables by value, range of keys by range of keys.

A digest of a range is its row count and the sum of its rows' hashes: it does
not depend on the order of rows or on partitions, and partial sums combine before
the shuffle. Two tables are compared by their digests alone; only ranges that
differ are looked into.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_hash(columns: Sequence[str]) -> Column:
    """64 bits of a row's values. NULLs count by their place, so a value that moves to the next column shows."""
    parts = [x for c in columns for x in (F.col(c).isNull(), F.col(c))]
    return F.xxhash64(*parts)


def key_range(key: str, width: int) -> Column:
    """First key of the range that a key lies in; NULL keys are a range of their own."""
    return (F.floor(F.col(key) / F.lit(width)) * width).cast("bigint")


def range_digests(df: DataFrame, key: str, width: int, columns: "Sequence[str] | None" = None) -> DataFrame:
    """``range_start, rows, digest`` of every range of ``width`` keys that has rows."""
    names = sorted(columns or df.columns)
    hashed = df.select(key_range(key, width).alias("range_start"), row_hash(names).cast("decimal(38,0)").alias("h"))
    return hashed.groupBy("range_start").agg(F.count(F.lit(1)).alias("rows"), F.sum("h").alias("digest"))


def reconcile(left: DataFrame, right: DataFrame, key: str, width: int, columns: "Sequence[str] | None" = None) -> DataFrame:
    """``range_start, left_rows, right_rows, same`` of every range that either table has.

    ``columns`` (default: those of both) are compared by value and type.
    """
    names = list(columns or [c for c in left.columns if c in right.columns])
    a = range_digests(left, key, width, names).select(F.struct("range_start").alias("r"), F.col("rows").alias("left_rows"), F.col("digest").alias("left_digest"))
    b = range_digests(right, key, width, names).select(F.struct("range_start").alias("r"), F.col("rows").alias("right_rows"), F.col("digest").alias("right_digest"))
    both = a.join(b, "r", "full")
    return both.select(
        F.col("r.range_start").alias("range_start"),
        F.coalesce("left_rows", F.lit(0)).alias("left_rows"),
        F.coalesce("right_rows", F.lit(0)).alias("right_rows"),
        (F.col("left_rows").eqNullSafe(F.col("right_rows")) & F.col("left_digest").eqNullSafe(F.col("right_digest"))).alias("same"),
    )


def differing_rows(left: DataFrame, right: DataFrame, key: str, width: int, columns: "Sequence[str] | None" = None) -> DataFrame:
    """``side, *columns`` of the rows that one table has and the other has not (or has less often), ranges that agree left out."""
    names = list(columns or [c for c in left.columns if c in right.columns])
    ranges = reconcile(left, right, key, width, names).where(~F.col("same")).select(F.struct("range_start").alias("r"))

    def counted(df: DataFrame, sign: int) -> DataFrame:
        inside = df.select(F.struct(key_range(key, width).alias("range_start")).alias("r"), *names).join(ranges, "r", "left_semi")
        return inside.select(*names, F.lit(sign).alias("n"))

    rows = counted(left, 1).unionByName(counted(right, -1)).groupBy(*names).agg(F.sum("n").alias("n")).where("n <> 0")
    side = F.when(F.col("n") > 0, "left").otherwise("right")
    return rows.select(side.alias("side"), F.explode(F.sequence(F.lit(1), F.abs("n"))).alias("_"), *names).drop("_")
