"""Published orders partitioned by order year, and their partial rewrite."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.layers import write_parquet

YEAR = "OrderYear"


def with_year(orders: DataFrame) -> DataFrame:
    return orders.withColumn(YEAR, F.year("OrderDate"))


def write_by_year(orders: DataFrame, path: str) -> int:
    """Overwrite ``path`` with the orders, a folder a year (and one for lines without a date); rows written.

    Every task writes a file for each year it has, so no row moves for it.
    """
    return write_parquet(with_year(orders), path, partition_by=(YEAR,))


def read_years(spark: SparkSession, path: str, years: "Sequence[int | None] | None" = None) -> DataFrame:
    """The orders of some years (None: without a date), or of all; other years' folders are not read."""
    orders = spark.read.parquet(path)
    if years is None:
        return orders
    known = [y for y in years if y is not None]
    wanted = F.col(YEAR).isin(known) if known else F.lit(False)
    return orders.where(wanted | F.col(YEAR).isNull() if None in years else wanted)


def replace_orders(spark: SparkSession, path: str, orders: DataFrame, key: str, staging: str) -> "list[int | None]":
    """Put ``orders`` in place of the rows with their keys; returns the years whose folders were rewritten.

    Touched are the years that have rows with such keys now and the years of the
    new rows. Their new content is written beside the table first, then into it
    by dynamic partition overwrite, which leaves other years alone. A year that
    has no row left is overwritten with none.
    """
    new = with_year(orders)
    keys = new.select(key).distinct()
    old = spark.read.parquet(path)
    held = old.join(keys, key, "left_semi").select(YEAR).union(new.select(YEAR)).distinct()
    years = sorted((r[YEAR] for r in held.collect()), key=lambda y: (y is not None, y))  # a number a year
    kept = read_years(spark, path, years).join(keys, key, "left_anti")
    write_parquet(kept.unionByName(new.select(*kept.columns)), staging, partition_by=(YEAR,))
    content = spark.read.schema(old.schema).parquet(staging)
    content.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(YEAR).parquet(path)
    left = {r[YEAR] for r in content.select(YEAR).distinct().collect()}
    for year in years:
        if year not in left:
            folder = f"{path.rstrip('/')}/{YEAR}={'__HIVE_DEFAULT_PARTITION__' if year is None else year}"
            content.limit(0).drop(YEAR).write.mode("overwrite").parquet(folder)
    return years
