from pyspark.sql import functions as F

from tidemark.functions.enrich import CategoryRule, category_from_rules, fill_blank
from tidemark.operators.keyed import first_n_by, keep_first_by_preference, top_n_per_group
from tidemark.plans import retail as R


def test_color_fill(spark):
    df = spark.createDataFrame([(None,), ("",), ("Red",)], "c string")
    assert [r[0] for r in df.select(fill_blank("c", "N/A")).collect()] == ["N/A", "N/A", "Red"]


def test_category_rules(spark):
    rows = [
        (None, "Gloves", "Clothing"),
        (None, "Helmets", "Accessories"),
        (None, "Road Frames", "Components"),
        (None, "mountain FRAMES", "Components"),
        ("", "Wheels", "Components"),
        (None, "gloves", None),  # exact lists are case-sensitive
        (None, None, None),
        ("", "Other", ""),  # blank without a match keeps ''
        ("Bikes", "Gloves", "Bikes"),  # populated category is kept
    ]
    df = spark.createDataFrame(rows, "cat string, sub string, expect string")
    got = df.select("expect", category_from_rules("cat", "sub").alias("got")).collect()
    assert [r.got for r in got] == [r.expect for r in got]


def test_custom_rules_first_match_wins(spark):
    rules = (CategoryRule("A", exact=("x",)), CategoryRule("B", exact=("x",), contains=("y",)))
    df = spark.createDataFrame([(None, "x"), (None, "zYz")], "cat string, sub string")
    assert [r[0] for r in df.select(category_from_rules("cat", "sub", rules)).collect()] == ["A", "B"]


def _store(spark, rows):
    df = spark.createDataFrame(rows, "ProductID string, ProductCategoryName string, Color string")
    return {r.Color: r for r in R.store_products(df).collect()}, R.store_products(df).count()


def test_dedupe_prefers_category(spark):
    got, n = _store(spark, [("1", None, "a"), ("1", "Bikes", "b"), ("2", "", "c"), ("2", None, "d")])
    assert n == 2
    assert "b" in got and got["b"].ProductCategoryName == "Bikes"
    # ('', NULL) tie on preference: broken by remaining columns, NULLs first -> category NULL row
    assert "d" in got


def test_dedupe_casts_ids_first(spark):
    _, n = _store(spark, [("1", "A", "a"), (" 1", "A", "b"), ("01", "A", "c"), ("1.0", "A", "f"), (None, "A", "d"), ("x", "A", "e")])
    assert n == 3  # id 1, the product 'x' and the one without any id


def test_dedupe_keeps_products_without_a_typed_id(spark):
    ids = ["AB-1", "AB-2", "99999999999999999999", "12", "12.5", " AB-1 "]
    df = spark.createDataFrame([(i,) for i in ids], "ProductID string")
    assert sorted((r.ProductID for r in R.store_products(df).collect()), key=str) == [12, None, None, None, None]
    p = R.product_profile(df).first()
    assert (p.total_rows, p.distinct_keys, p.null_keys, p.duplicate_rows) == (6, 1, 5, 1)


def test_hot_key_beyond_the_planned_limit(spark):
    """n = 1001: no partial window limit is planned, so the hot key is ranked part by part first."""
    df = spark.range(6000).select(F.when(F.col("id") < 5000, 1).otherwise(2).alias("k"), F.col("id").alias("v"))
    out = first_n_by(df, ["k"], [F.col("v").desc()], n=1001)
    assert out.columns == ["k", "v"]
    got = {r.k: (r.n, r.lo) for r in out.groupBy("k").agg(F.count("*").alias("n"), F.min("v").alias("lo")).collect()}
    assert got == {1: (1001, 3999), 2: (1000, 5000)}


def test_dedupe_deterministic_across_partitions(spark):
    rows = [(str(i % 50), None if i % 3 else "C", f"c{i}") for i in range(600)]
    df = spark.createDataFrame(rows, "ProductID string, ProductCategoryName string, Color string")
    a = sorted(R.store_products(df.repartition(1)).collect())
    b = sorted(R.store_products(df.repartition(37)).collect())
    assert a == b


def test_top_n_per_group(spark):
    df = spark.createDataFrame(
        [(1, "a", 5.0), (1, "b", 7.0), (1, "c", 7.0), (1, "d", None), (None, "e", 1.0), (2, "f", None)],
        "g int, item string, v double",
    )
    top = {r.g: r.item for r in top_n_per_group(df, ["g"], "v", 1, tiebreak=["item"]).collect()}
    assert top == {1: "b", None: "e", 2: "f"}
    two = top_n_per_group(df, ["g"], "v", 2, tiebreak=["item"]).filter(F.col("g") == 1).collect()
    assert sorted(r.item for r in two) == ["b", "c"]


def test_first_n_rejects_zero(spark):
    import pytest

    df = spark.createDataFrame([(1,)], "k int")
    with pytest.raises(ValueError):
        first_n_by(df, ["k"], [], n=0)


def test_keep_first_plan_limits_before_shuffle(spark):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    from support import plan_text

    plan = plan_text(keep_first_by_preference(df, ["k"], [F.col("v")]))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_dedupe_without_category_column(spark):
    df = spark.createDataFrame([("1", "b"), ("1", "a"), ("2", "c")], "ProductID string, Color string")
    assert sorted(tuple(r) for r in R.store_products(df).collect()) == [(1, "a"), (2, "c")]


def test_colour_through_store_and_publish(spark):
    """Raw colour text -> trimmed -> blank filled (FIXTURES product rows)."""
    df = spark.createDataFrame(
        [("1", None), ("2", ""), ("3", "   "), ("4", "  Red ")], "ProductID string, Color string"
    )
    got = {r.ProductID: r.Color for r in R.publish_product(R.store_products(df)).collect()}
    assert got == {1: "N/A", 2: "N/A", 3: "N/A", 4: "Red"}
