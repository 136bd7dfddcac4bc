"""Quarantine, reconciliation by value, year partitions, sorted exports, sketches and schema drift."""

import csv
import glob
import os

import pytest
from pyspark.sql import functions as F

from support import SF_SMOKE, plan_text
from tidemark.functions.cleanse import Role
from tidemark.operators import drift, quarantine, reconcile, sketches
from tidemark.operators.typing import rejected_values
from tidemark.plans import registry_layers
from tidemark.plans import retail as R
from tidemark.plans.options import PipelineOptions
from tidemark.sources import exports, yearly
from tidemark.sources.layers import write_parquet
from tidemark.sources.tpch_roles import raw_tables


def as_rows(df):
    return sorted(tuple(str(v) for v in r) for r in df.collect())


# ------------------------------------------------------------------ quarantine


@pytest.mark.parametrize(("table", "roles", "key"), [("detail", R.DETAIL_ROLES, "SalesOrderID"), ("header", R.HEADER_ROLES, "SalesOrderID"), ("products", R.PRODUCT_ROLES, "ProductID")])
def test_reject_rows_sum_to_the_counts(spark, table, roles, key):
    raw = getattr(raw_tables(spark, SF_SMOKE), table)
    rows = quarantine.rejected_rows(raw, roles, table, key)
    counts = rejected_values(raw, roles).first().asDict()
    want = {name.removesuffix("_rejected"): n for name, n in counts.items() if name != "rows" and n}
    assert {r.column_name: r["count"] for r in rows.groupBy("column_name").count().collect()} == want
    assert "Exchange" not in plan_text(rows)


def test_reject_rows_say_key_text_and_reason(spark):
    raw = spark.createDataFrame([("1", "x", "yes"), ("q", None, "true"), (None, "2.5", " true")], "SalesOrderID string, OrderQty string, OnlineOrderFlag string")
    roles = {"SalesOrderID": Role.KEY, "OrderQty": Role.INT, "OnlineOrderFlag": Role.FLAG, "Absent": Role.INT}
    assert as_rows(quarantine.rejected_rows(raw, roles, "d", "SalesOrderID")) == [
        ("d", "1", "OnlineOrderFlag", "yes", "neither true nor false"),
        ("d", "1", "OrderQty", "x", "no 32-bit integer"),
        ("d", "None", "OnlineOrderFlag", " true", "neither true nor false"),
        ("d", "q", "SalesOrderID", "q", "no identifier"),
    ]


def test_malformed_lines_are_kept(spark, scratch):
    with open(f"{scratch}/a.csv", "w") as out:
        out.write('k,v\n1,a\n2\n3,c,d\n"4",\n,\n5,"x,y"\n')
    good, bad = quarantine.read_csv_with_faults(spark, f"{scratch}/a.csv", ["k", "v"])
    assert good.count() == 4 and good.select("k").count() == 4
    assert as_rows(good) == [("1", "a"), ("4", "None"), ("5", "x,y"), ("None", "None")]
    lines = bad.collect()
    assert sorted(r.line for r in lines) == ["2", "3,c,d"] and all(r.file.endswith("a.csv") for r in lines)


# -------------------------------------------------------------- reconciliation


def test_one_changed_value_is_located(spark):
    rows = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("a"), F.when(F.col("id") % 5 == 0, None).otherwise(F.col("id") / 3).alias("b"))
    other = rows.withColumn("b", F.when(F.col("k") == 2345, -1.0).otherwise(F.col("b")))
    assert reconcile.reconcile(rows, rows.repartition(7), "k", 100).where("not same").count() == 0
    assert reconcile.reconcile(rows, other, "k", 100).where("not same").select("range_start", "left_rows", "right_rows").collect() == [(2300, 100, 100)]
    assert as_rows(reconcile.differing_rows(rows, other, "k", 100)) == [("left", "2345", "0", "None"), ("right", "2345", "0", "-1.0")]
    swapped = rows.where("k <> 10").unionByName(rows.where("k = 10").select("k", F.col("b").cast("bigint").alias("a"), F.col("a").cast("double").alias("b")))
    assert reconcile.reconcile(rows, swapped, "k", 100).where("not same").count() == 1


def test_reconcile_counts_null_keys_missing_and_repeated_rows(spark):
    left = spark.createDataFrame([(None, "a"), (1, "b"), (1, "b"), (-5, "c")], "k int, v string")
    right = spark.createDataFrame([(None, "a"), (1, "b"), (900, "d")], "k int, v string")
    got = {r.range_start: (r.left_rows, r.right_rows, r.same) for r in reconcile.reconcile(left, right, "k", 10).collect()}
    assert got == {None: (1, 1, True), 0: (2, 1, False), -10: (1, 0, False), 900: (0, 1, False)}
    assert as_rows(reconcile.differing_rows(left, right, "k", 10)) == [("left", "-5", "c"), ("left", "1", "b"), ("right", "900", "d")]
    assert reconcile.reconcile(left.limit(0), right.limit(0), "k", 10).count() == 0


# ------------------------------------------------------------- year partitions


@pytest.fixture(scope="module")
def smoke_orders(spark):
    raw = raw_tables(spark, SF_SMOKE)
    return {i: R.build(raw, PipelineOptions(impute_orderdate=i)).publish_orders for i in (False, True)}


def test_year_filter_reads_one_folder(spark, scratch, smoke_orders):
    path = f"{scratch}/orders"
    orders = smoke_orders[False]
    assert yearly.write_by_year(orders, path) == orders.count()
    one = yearly.read_years(spark, path, [1995])
    plan = plan_text(one)
    assert "PartitionFilters: [" in plan and "1995" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert as_rows(one.select(orders.columns)) == as_rows(orders.where(F.year("OrderDate") == 1995))
    assert {r[0].split("OrderYear=")[1][:4] for r in one.select("_metadata.file_path").distinct().collect()} == {"1995"}
    undated = yearly.read_years(spark, path, [None])
    assert undated.count() == orders.where("OrderDate is null").count() > 0
    assert as_rows(yearly.read_years(spark, path).select(orders.columns)) == as_rows(orders)


def test_imputed_orders_rewrite_touched_years_only(spark, scratch, smoke_orders):
    path = f"{scratch}/orders"
    before, after = smoke_orders[False], smoke_orders[True]
    yearly.write_by_year(before, path)
    files = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/*/*.parquet")}
    undated = before.where("OrderDate is null").select(R.ORDER_KEY).distinct()
    year = after.join(undated, R.ORDER_KEY, "left_semi").where("OrderDate is not null").agg(F.min(F.year("OrderDate"))).first()[0]
    keys = after.where(F.year("OrderDate") == year).join(before.where("OrderDate is null").select(R.ORDER_KEY).distinct(), R.ORDER_KEY, "left_semi").select(R.ORDER_KEY).distinct()
    years = yearly.replace_orders(spark, path, after.join(keys, R.ORDER_KEY, "left_semi"), R.ORDER_KEY, f"{scratch}/staging1")
    assert years == [None, year]
    same = {f for f, t in files.items() if os.path.exists(f) and os.stat(f).st_mtime_ns == t}
    assert {f.split("OrderYear=")[1].split("/")[0] for f in files.keys() - same} == {"__HIVE_DEFAULT_PARTITION__", str(year)}
    # all of the rest: the folder without a date is emptied where every line gets one
    rest = before.where("OrderDate is null").select(R.ORDER_KEY).distinct()
    yearly.replace_orders(spark, path, after.join(rest, R.ORDER_KEY, "left_semi"), R.ORDER_KEY, f"{scratch}/staging2")
    assert as_rows(yearly.read_years(spark, path).select(after.columns)) == as_rows(after)


def test_emptied_year_holds_no_stale_rows(spark, scratch):
    rows = spark.createDataFrame([(1, None), (2, "1999-05-05 00:00:00")], "SalesOrderID int, d string").select("SalesOrderID", F.col("d").cast("timestamp_ntz").alias("OrderDate"))
    yearly.write_by_year(rows, f"{scratch}/o")
    dated = rows.where("SalesOrderID = 1").withColumn("OrderDate", F.lit("1999-01-01").cast("timestamp_ntz"))
    assert yearly.replace_orders(spark, f"{scratch}/o", dated, "SalesOrderID", f"{scratch}/s") == [None, 1999]
    assert as_rows(yearly.read_years(spark, f"{scratch}/o").select("SalesOrderID", "OrderYear")) == [("1", "1999"), ("2", "1999")]


# -------------------------------------------------------------- sorted exports


def test_export_concatenates_to_the_order(spark, scratch):
    rows = spark.range(3000).select((F.col("id") * 7919 % 3001).alias("k"), F.when(F.col("id") % 11 == 0, None).otherwise(F.concat(F.lit(" v"), F.col("id") % 13)).alias("v"))
    rows = rows.unionByName(spark.createDataFrame([(None, "x"), (None, None)], "k bigint, v string")).repartition(5)
    manifest = sorted(exports.write_sorted_csv(rows, f"{scratch}/out", ["v", "k"], 6).collect())
    assert len(manifest) > 3 and max(r["rows"] for r in manifest) < 1500
    got, at = [], 0
    for part, count, first in manifest:
        assert first == at
        names = sorted(glob.glob(f"{scratch}/out/__part={part}/*.csv"))
        assert len(names) == 1
        with open(names[0], newline="") as f:
            lines = list(csv.reader(f))[1:]
        assert len(lines) == count
        got += lines
        at += count
    want = [["" if x is None else str(x) for x in r] for r in rows.orderBy(F.asc_nulls_first("v"), F.asc_nulls_first("k")).collect()]
    assert got == want
    assert exports.write_sorted_csv(rows.limit(0), f"{scratch}/none", ["k"], 4).count() == 0


# -------------------------------------------------------------------- sketches


def test_merged_sketches_estimate_the_profile(spark):
    rows = spark.range(60_000).select((F.col("id") % 9).cast("int").alias("d"), F.when(F.col("id") % 1000 == 0, None).otherwise(F.col("id") % 20_011).alias("k"))
    late = spark.createDataFrame([(3, 5), (3, 999_999)], "d int, k bigint")
    days = sketches.daily_sketches(rows, "lines", "d", "k").unionByName(sketches.daily_sketches(late, "lines", "d", "k"))
    assert days.count() == 10
    got = sketches.merged_profile(days).first()
    both = rows.unionByName(late)
    exact = both.select("k").where("k is not null").distinct().count()
    assert (got.dataset, got.total_rows, got.null_keys) == ("lines", 60_002, 60)
    assert abs(got.distinct_estimate - exact) <= 4 * sketches.standard_error() * exact
    assert got.duplicate_estimate == got.total_rows - got.distinct_estimate - 1
    assert sketches.merged_profile(days.limit(0)).count() == 0


# ---------------------------------------------------------------- schema drift


def test_schema_changes_are_rows(spark):
    roles = {"SalesOrderID": Role.KEY, "OrderQty": Role.INT}
    old = drift.contract(spark, "d", ["SalesOrderID", "OrderQty", "UnitPrice", "Color"], roles)
    new = drift.contract(spark, "d", ["SalesOrderID", "UnitPrice", "OrderQty", "color", "Note"], {**roles, "UnitPrice": Role.DOUBLE})
    assert as_rows(drift.schema_changes(old, new)) == [
        ("d", "Color", "renamed", "Color", "color"),
        ("d", "Note", "added", "None", "text"),
        ("d", "OrderQty", "moved", "1", "2"),
        ("d", "UnitPrice", "retyped", "text", "double"),
    ]
    assert drift.schema_changes(old, old).count() == 0
    frame = spark.createDataFrame([(1, "a")], "k int, v string")
    assert as_rows(drift.schema_changes(drift.written_contract(frame, "x"), drift.written_contract(frame.drop("v"), "x"))) == [("x", "v", "missing", "string", "None")]


def test_layers_of_several_schemas_lose_no_column_and_no_row(spark, scratch):
    write_parquet(spark.createDataFrame([(1, "1.5", 2)], "k int, price string, a tinyint"), f"{scratch}/v1")
    write_parquet(spark.createDataFrame([(2, 2.5, "n"), (3, None, None)], "k bigint, price double, note string"), f"{scratch}/v2")
    both = drift.read_together(spark, [f"{scratch}/v1", f"{scratch}/v2"], {"price": "double"})
    assert dict(both.dtypes) == {"k": "bigint", "price": "double", "a": "tinyint", "note": "string"}
    assert as_rows(both) == [("1", "1.5", "2", "None"), ("2", "2.5", "None", "n"), ("3", "None", "None", "None")]
    assert dict(drift.read_together(spark, [f"{scratch}/v2", f"{scratch}/v1"]).dtypes)["price"] == "string"
    with pytest.raises(ValueError, match="no paths"):
        drift.read_together(spark, [])


# ------------------------------------------------------------------ shared folder


@pytest.fixture
def cluster_master(monkeypatch, spark):
    """The session's settings as a cluster's: its shared folder is a mounted ``file:`` one."""
    plain = type(spark.conf).get
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, *a: "spark://host:7077" if key == "spark.master" else plain(self, key, *a))


def test_a_configured_file_folder_is_used_on_any_master(spark, cluster_master):
    assert registry_layers.working_base(spark).startswith(spark.conf.get("spark.checkpoint.dir") + "/tidemark-")


@pytest.mark.parametrize("name", ["bucketed_orders", "orders_of_year"])
def test_layer_queries_run_on_any_master(spark, cluster_master, name):
    assert registry_layers.QUERIES[name](spark, SF_SMOKE).count() > 0
