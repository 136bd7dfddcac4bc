"""Rules as data against rules as code; bucketed layers against the plain join."""

import uuid

import pytest
from pyspark.sql import functions as F

from support import SF_SMOKE, plan_text
from tidemark.functions.enrich import DEFAULT_CATEGORY_RULES, CategoryRule, category_from_rules
from tidemark.operators.rules import RULE_SCHEMA, fill_categories, invalid_rules, matched_categories, rule_table
from tidemark.plans import retail as R
from tidemark.sources import bucketed
from tidemark.sources.bucketed import Buckets
from tidemark.sources.tpch_roles import raw_tables

PRODUCTS = "ProductID int, ProductCategoryName string, ProductSubCategoryName string, matched string"
ROWS = [
    (1, None, "Gloves", "x"), (2, "", "Road Frames", None), (3, "Kept", "Gloves", "x"), (4, None, None, "x"), (5, "", "gloves", "x"),
    (6, None, "FRAMES", "x"), (7, "  ", "Wheels", "x"), (8, None, "Wheels", "x"), (8, None, "Wheels", "x"), (9, "", "", "x"), (10, None, "f", "x"),
]


def as_rows(df):
    return sorted((tuple(str(v) for v in r) for r in df.collect()))


@pytest.mark.parametrize(
    "rules",
    [
        DEFAULT_CATEGORY_RULES,
        (),
        (CategoryRule("All", contains=("",)),),
        (CategoryRule("A", contains=("frames", "love")), CategoryRule("B", exact=("Gloves", "FRAMES", "")), CategoryRule("C", contains=("F",))),
    ],
)
def test_rule_table_gives_the_rows_of_rules_in_code(spark, rules):
    products = spark.createDataFrame(ROWS, PRODUCTS).drop("matched")
    by_code = products.withColumn("ProductCategoryName", category_from_rules("ProductCategoryName", "ProductSubCategoryName", rules))
    assert as_rows(fill_categories(products, rule_table(spark, rules))) == as_rows(by_code)


def test_whole_product_table(spark):
    store = R.store_products(raw_tables(spark, SF_SMOKE).products)
    by_table = fill_categories(store, rule_table(spark)).withColumn("Color", F.coalesce(F.nullif("Color", F.lit("")), F.lit("N/A")))
    assert as_rows(by_table) == as_rows(R.publish_product(store))


def test_changed_table_changes_the_answer_without_code(spark):
    products = spark.createDataFrame(ROWS, PRODUCTS).drop("matched")
    more = rule_table(spark).union(spark.createDataFrame([(0, "contains", "GLOVE", "Winter")], RULE_SCHEMA))
    got = {r.ProductID: r.ProductCategoryName for r in fill_categories(products, more).collect()}
    assert got[1] == got[5] == "Winter" and got[3] == "Kept" and got[8] == "Components"


def test_ties_faulty_rules_and_no_cross_join(spark):
    rules = spark.createDataFrame(
        [(1, "exact", "Gloves", "b"), (1, "exact", "Gloves", "a"), (None, "exact", "Wheels", "n"), (0, "like", "Wheels", "n"), (0, "exact", None, "n"), (0, "contains", "w", None)],
        RULE_SCHEMA,
    )
    products = spark.createDataFrame(ROWS, PRODUCTS)
    got = matched_categories(products, "ProductSubCategoryName", rules)
    assert as_rows(got) == [("Gloves", "a")]
    assert sorted(r.reason for r in invalid_rules(rules).collect()) == ["no category", "no pattern", "no priority", "unknown kind"]
    plan = plan_text(fill_categories(products.drop("matched"), rule_table(spark)))
    assert "Cartesian" not in plan and "NestedLoop" not in plan


@pytest.fixture
def tables(spark, scratch):
    names = tuple(f"{x}_{uuid.uuid4().hex}" for x in ("detail", "header"))
    yield names, f"file://{scratch}/bucketed"
    bucketed.drop_tables(spark, names)


def test_bucketed_join_moves_neither_side(spark, tables):
    names, base = tables
    raw = raw_tables(spark, SF_SMOKE)
    detail, header = R.store_detail(raw.detail), R.store_header(raw.header)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pair = bucketed.bucketed_pair(detail, header, names, base, Buckets(R.ORDER_KEY, 5))
        plan = plan_text(R.publish_orders(*pair))
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert "Exchange" in plan_text(R.publish_orders(detail, header))
        assert as_rows(R.publish_orders(*pair)) == as_rows(R.publish_orders(detail, header))
        counts = {r.bucket: r["rows"] for r in bucketed.bucket_counts(detail, Buckets(R.ORDER_KEY, 5)).collect()}
        assert sum(counts.values()) == pair[0].count() and set(counts) <= set(range(5))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_hot_key_is_left_unbucketed(spark, tables):
    names, base = tables
    hot = spark.range(2000).select(F.when(F.col("id") < 1400, 7).otherwise(F.col("id")).alias("k"))
    buckets = Buckets("k", 50)
    assert bucketed.largest_bucket(hot, buckets) > 30
    assert bucketed.bucketed_pair(hot, hot.distinct(), names, base, buckets) is None
    assert bucketed.largest_bucket(hot.limit(0), buckets) == 1.0
    with pytest.raises(ValueError, match="at least one bucket"):
        Buckets("k", 0)
