import datetime as dt

import pytest
from support import plan_text
from pyspark.sql import functions as F

from tidemark.operators import analysis, joins, quality

D = dt.datetime


def test_lines_with_header_semantics(spark):
    det = spark.createDataFrame([(1, 10), (1, 11), (2, 12), (None, 13), (9, 14)], "k long, v int")
    hdr = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b2")], "k long, h string")
    out = joins.lines_with_header(det, hdr, "k")
    assert out.columns == ["k", "v", "h"]
    assert sorted(tuple(r) for r in out.collect()) == [(1, 10, "a"), (1, 11, "a"), (2, 12, "b"), (2, 12, "b2")]


def test_lines_with_header_keeps_both_values_of_a_clash(spark):
    det = spark.createDataFrame([(1, 1, 5)], "k long, x int, Header_x int")
    hdr = spark.createDataFrame([(1, 2)], "k long, x int")
    out = joins.lines_with_header(det, hdr, "k")
    assert out.columns == ["k", "x", "Header_x", "Header_Header_x"]
    assert [tuple(r) for r in out.collect()] == [(1, 1, 5, 2)]


def test_dimension_join_carries_no_hint(spark):
    fact = spark.range(100).withColumnRenamed("id", "k")
    dim = spark.range(10).withColumnRenamed("id", "k").withColumn("a", F.lit("x"))
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in plan_text(joins.join_dimension(fact, dim, "k", "left"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)


def test_orphan_counts_read_the_lines_once(spark):
    fact = spark.createDataFrame([(1, 1), (2, None), (None, 9), (1, 1)], "a long, b long")
    dims = {
        "no_a": (spark.createDataFrame([(1,), (1,), (None,)], "a long"), "a"),
        "no_b": (spark.createDataFrame([(1,)], "b long"), "b"),
    }
    counts = analysis.stacked(joins.orphan_counts(fact, dims), list(dims))
    assert {r.dataset: r.rows for r in counts.collect()} == {"no_a": 2, "no_b": 2}


def test_join_counts_equal_the_join(spark):
    left = spark.createDataFrame([(1,), (1,), (2,), (None,), (3,)], "k long")
    right = spark.createDataFrame([(1,), (1,), (3,), (None,), (4,)], "k long")
    row = analysis.join_counts(left, right, "k").first()
    assert tuple(row) == (5, 5, left.join(right, "k").count()) == (5, 5, 5)


def test_left_dimension_join_keeps_unmatched(spark):
    fact = spark.createDataFrame([(1,), (2,), (None,)], "k long")
    dim = spark.createDataFrame([(1, "Red")], "k long, c string")
    got = sorted(joins.join_dimension(fact, dim, "k").collect(), key=lambda r: (r.k is None, r.k))
    assert [(r.k, r.c) for r in got] == [(1, "Red"), (2, None), (None, None)]


def test_orphans_include_null_keys(spark):
    fact = spark.createDataFrame([(1,), (2,), (None,)], "k long")
    dim = spark.createDataFrame([(1,)], "k long")
    assert sorted(joins.orphans(fact, dim, "k").collect(), key=str) == sorted([(2,), (None,)], key=str)


def _published(spark, rows):
    schema = (
        "OrderQty int, TotalLineExtendedPrice double, TotalOrderFreight double, "
        "OrderDate timestamp_ntz, ShipDate timestamp_ntz, LeadTimeInBusinessDays int"
    )
    return spark.createDataFrame(rows, schema)


def test_order_checks(spark):
    schema = (
        "OrderQty int, TotalLineExtendedPrice double, TotalOrderFreight double, OrderDate timestamp_ntz, "
        f"ShipDate timestamp_ntz, LeadTimeInBusinessDays int, {quality.HEADER_NO} int"
    )
    lines = spark.createDataFrame(
        [
            (1, 10.0, 5.0, D(2024, 1, 8), D(2024, 1, 10), 2, 1),
            (1, -10.0, -1.0, D(2024, 1, 10), D(2024, 1, 8), 0, 1),  # sign mismatch, negative freight, reversed
            (-1, -10.0, 0.0, None, D(2024, 1, 8), None, 1),  # a return: signs agree; lead missing
            (-1, float("nan"), 0.0, None, D(2024, 1, 8), None, 2),  # the same line at a second header, without a price
            (1, 1e20, 0.0, D(2024, 1, 8), D(2024, 1, 10), 2, 1),
            (1, None, None, None, None, None, None),  # no header
        ],
        schema,
    )
    checks = quality.order_checks(lines, required=["OrderQty", "TotalOrderFreight", "Missing"])
    got = {r.check: (r.violations, r.checked) for r in checks.collect()}
    assert got == {
        "published_nonempty": (0, 5),
        "negative_freight": (1, 5),
        "price_sign_mismatch": (2, 5),  # NaN compares above zero
        "unusual_price": (2, 5),
        "ship_before_order": (1, 5),
        "lead_time_missing": (2, 5),
        "join_row_change": (0, 5),
        "lines_without_header": (1, 5),
        "required_columns": (1, 3),
    }


def test_table_checks(spark):
    got = {r.check: (r.violations, r.checked) for r in quality.table_checks("t", spark.range(0), ["id", "x"]).collect()}
    assert got == {"t_nonempty": (1, 0), "t_required_columns": (1, 2)}


def test_numbered_headers_share_the_join_shuffle(spark):
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hdr = quality.numbered_headers(spark.createDataFrame([(1, "a")], "k long, h string"), "k")
        plan = plan_text(joins.lines_with_header(spark.createDataFrame([(1, 2)], "k long, v int"), hdr, "k", how="left"), "simple")
        assert plan.count("Exchange") == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)


def test_lead_time_edges(spark):
    pub = _published(
        spark,
        [
            (1, 1.0, 0.0, D(2021, 5, 31), D(2021, 6, 2), 2),
            (1, 1.0, 0.0, D(2021, 6, 4), D(2021, 6, 7), 1),
            (1, 1.0, 0.0, D(2021, 6, 4), D(2021, 6, 4), 1),  # wrong: same day must be 0
            (1, 1.0, 0.0, D(2021, 6, 9), D(2021, 6, 16), 5),
        ],
    )
    got = {r.check: (r.violations, r.checked) for r in quality.lead_time_edges(pub).collect()}
    assert got["mon_to_wed"] == (0, 1)
    assert got["fri_to_mon"] == (0, 1)
    assert got["same_day"] == (1, 1)
    assert got["seven_day_span"] == (0, 1)
    assert got["recomputed"] == (1, 4)


def test_missing_columns(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert quality.missing_columns(df, ["a", "b"]) == ["b"]


def test_money_sum_is_order_independent(spark):
    vals = [(0.1,), (0.2,), (0.3,)] * 1000 + [(9e8,), (-9e8,)]
    df = spark.createDataFrame(vals, "x double")
    a = df.repartition(1).agg(analysis.money_sum("x")).first()[0]
    b = df.repartition(64).agg(analysis.money_sum("x")).first()[0]
    assert a == b == 600.0


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_money_sum_loses_no_line(spark, ansi):
    nan, inf = float("nan"), float("inf")
    cases = [
        ([10.0, nan], nan), ([10.0, inf], inf), ([10.0, -inf], -inf), ([inf, -inf], nan), ([10.0, 1e20], 1e20),
        ([0.123456, 0.000001], 0.123457), ([None, None], None), ([None, 1.5], 1.5), ([1e9], 1e9), ([-2e9, 0.5], -2e9 + 0.5),
        ([0.1234567890123] * 10, 1.234567890123),
    ]
    prev = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        rows = [(i, v) for i, (vs, _) in enumerate(cases) for v in vs]
        df = spark.createDataFrame(rows, "g int, x double").groupBy("g").agg(analysis.money_sum("x").alias("s"))
        got = {r.g: r.s for r in df.collect()}
    finally:
        spark.conf.set("spark.sql.ansi.enabled", prev)
    assert [repr(got[i]) for i in range(len(cases))] == [repr(want) for _, want in cases]


def test_duplicate_profile_and_coverage(spark):
    df = spark.createDataFrame([(1, 1), (1, None), (2, 3), (None, 4), (None, None)], "k long, v int")
    p = analysis.duplicate_profile(df, "k").first()
    assert (p.total_rows, p.distinct_keys, p.null_keys, p.duplicate_rows) == (5, 2, 2, 2)
    named = df.withColumn("d", F.coalesce(F.col("k").cast("string"), F.col("v").cast("string")))
    p = analysis.duplicate_profile(named, "k", "d").first()
    assert (p.total_rows, p.distinct_keys, p.null_keys, p.duplicate_rows) == (5, 2, 2, 1)
    p = analysis.duplicate_profile(df.limit(0), "k").first()
    assert tuple(p) == (0, 0, 0, 0)
    c = analysis.coverage(df, "v").first()
    assert (c.rows_with_value, c.total_rows, c.pct_with_value) == (3, 5, 60.0)


def test_formula_comparison(spark):
    df = spark.createDataFrame([(100.0, 90.0, -10.0), (50.0, 50.0, 0.0)], "s double, c double, g double")
    r = analysis.formula_comparison(df, "s", "c", "g").first()
    assert (r.Total_Spec, r.Total_Correct, r.Total_Rows) == (150.0, 140.0, 2)
    assert (r.Min_Diff_Pct, r.Max_Diff_Pct, r.Avg_Diff_Pct) == (-10.0, 0.0, -5.0)
    assert (r.Ordinary_Spec, r.Ordinary_Correct, r.Unusual_Lines) == (150.0, 140.0, 0)
    assert r.Diff_Amount == -10.0 and r.Diff_Pct_Total == pytest.approx(-6.666666666666667)
