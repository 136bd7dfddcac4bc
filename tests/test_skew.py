"""A hot key holding a third of all lines: the join is split, results whole."""

import pytest
from support import plan_text
from pyspark.sql import functions as F

from tidemark.operators.keyed import keep_first_by_preference
from tidemark.plans import retail as R


def test_hot_order_key_is_split_and_complete(spark):
    n = 300_000
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    prev = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        ids = spark.range(n, numPartitions=8)
        # a third of all lines belong to order 7
        key = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id"))
        detail = ids.select(
            key.cast("string").alias("SalesOrderID"),
            (F.col("id") % 5).cast("string").alias("SalesOrderDetailID"),
            F.lit("2").alias("OrderQty"),
            F.lit("1").alias("ProductID"),
            F.col("id").cast("string").alias("UnitPrice"),  # distinct values: shuffle blocks do not compress away
            F.lit("0.0").alias("UnitPriceDiscount"),
        )
        header = spark.range(n, numPartitions=8).select(
            F.col("id").cast("string").alias("SalesOrderID"),
            F.lit("2024-01-08").alias("OrderDate"),
            F.lit("2024-01-10").alias("ShipDate"),
            F.lit("1.0").alias("Freight"),
        )
        po = R.publish_orders(R.store_detail(detail), R.store_header(header))
        agg = po.agg(F.count(F.lit(1)).alias("n"), F.sum("TotalLineExtendedPrice").alias("rev"))
        row = agg.collect()[0]
        assert row.n == n  # every line kept, none dropped or sampled
        assert row.rev == 2.0 * (n * (n - 1) // 2)
        assert "skew=true" in plan_text(agg, "simple")
    finally:
        for k, v in prev.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


@pytest.mark.parametrize("hot", ["5", None])
def test_hot_and_null_product_is_split_and_complete(spark, hot):
    """A third of the lines has one product, or none: the left join keeps every line under a forced sort-merge join."""
    n = 150_000
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    prev = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        ids = spark.range(n, numPartitions=8)
        lines = ids.select(
            F.when(F.col("id") % 3 == 0, F.lit(hot).cast("long")).otherwise(F.col("id")).alias("ProductID"),
            F.col("id").cast("double").alias("amount"),
            F.lit(None).cast("timestamp_ntz").alias("OrderDate"),
        )
        product = ids.select(F.col("id").alias("ProductID"), F.lit("Red").alias("Color"), F.lit("c").alias("ProductCategoryName"))
        out = R.orders_with_product(lines, product).agg(
            F.count(F.lit(1)).alias("n"), F.count("Color").alias("matched"), F.sum("amount").alias("s")
        )
        row = out.collect()[0]
        assert (row.n, row.s) == (n, float(n * (n - 1) // 2))
        assert row.matched == (n if hot else n - n // 3)
        assert "skew=true" in plan_text(out, "simple")
    finally:
        for k, v in prev.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_key_dedupe_ships_one_row_per_task(spark):
    """Partial WindowGroupLimit runs before the shuffle, so a key holding a
    third of the rows crosses the network as at most one row per map task."""
    rows = spark.range(9000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    out = keep_first_by_preference(rows, ["k"], [F.col("v").desc()])
    assert out.filter(F.col("k") == 1).first().v == 8997
    assert out.count() == 6000  # keys: 1 (ids divisible by 3, and id 1) plus the other 5999 ids
    plan = plan_text(out, "simple")
    partial = plan.index("Partial")
    assert plan.index("Exchange") < partial  # the partial limit sits below (before) the shuffle
