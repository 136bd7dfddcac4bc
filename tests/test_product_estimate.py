"""The product view's rows, and that Spark's estimate of them does not shrink below what it makes of the file."""

import os

from pyspark.sql import functions as F
from support import plan_text

from tidemark.plans import retail as R
from tidemark.sources.tpch_roles import raw_products

PART = "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"


def test_products_are_not_broadcast_by_a_shrunken_estimate(spark, scratch):
    """Three of 15 selected columns are at least a third of the file, not a sixth of it: over the threshold, they are joined by sort-merge."""
    path = f"{scratch}/part.parquet"
    parts = spark.range(3000, numPartitions=1).select(
        F.col("id").alias("p_partkey"), F.lit("red bolt").alias("p_name"), F.lit("b").alias("p_brand"),
        F.lit("t").alias("p_type"), F.lit(1).alias("p_size"), F.rand(1).alias("p_retailprice"),
    )
    parts.write.parquet(path)
    size = sum(os.path.getsize(f"{path}/{f}") for f in os.listdir(path) if f.endswith(".parquet"))
    lines = spark.range(100).select(F.col("id").alias("ProductID"), F.lit(None).cast("timestamp_ntz").alias("OrderDate"))
    product = R.publish_product(R.store_products(raw_products(spark.read.parquet(path))))
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(size // 3))
    try:
        out = R.orders_with_product(lines, product)
        plan = plan_text(out, "simple")
        assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan
        assert out.where("Color is not null").count() == 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)


def test_rows_of_each_part(spark):
    parts = spark.createDataFrame([(k, "red bolt", "b", "t", 10, 2.5) for k in (59, 1, 2, 3, 4, None)], PART)
    rows = [(r.ProductID, r.ProductDesc, r.Color, r.ProductCategoryName, r.StandardCost, r.Weight) for r in raw_products(parts).collect()]
    assert len(rows) == 2 * 6 + 4
    assert set(rows) == {
        ("59", " red bolt ", "Red", "t", "", "10e-1"), (" 59", "red bolt (old)", "Silver", "Legacy", "1.5", None),
        (" AB-59", "red bolt (code)", "Silver", "Legacy", "1.5", None),
        ("1", " red bolt ", "Red", "t", "", "10e-1"), (" 1", "red bolt (old)", "Silver", "Legacy", "1.5", None),
        ("99999999999999999991", "red bolt (long)", "Silver", "Legacy", "1.5", None),
        ("2", " red bolt ", "Red", "t", "", "10e-1"), (" 2", "red bolt (old)", "Silver", None, "1.5", None),
        ("2.5", "red bolt (half)", "Silver", None, "1.5", None),
        ("3", " red bolt ", "Red", "  ", "", "10e-1"), (" 3", "red bolt (old)", "Silver", "Legacy", "1.5", None),
        (None, "red bolt (none)", "Silver", "Legacy", "1.5", None),
        ("4", " red bolt ", "Red", "t", "", "10e-1"), (" 4", "red bolt (old)", "Silver", None, "1.5", None),
        (None, " red bolt ", "Red", "t", "", "10e-1"), (None, "red bolt (old)", "Silver", "Legacy", "1.5", None),
    }
