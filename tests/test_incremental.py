"""Incremental layers against full runs: new, changed, removed and repeated input, and runs that were stopped."""

import os

import pytest
from pyspark.sql import functions as F

from tidemark.operators.partials import merge_states, partial_state, state_mean, state_money
from tidemark.operators.analysis import mean_by, revenue_by
from tidemark.plans import incremental as I
from tidemark.plans import retail as R
from tidemark.plans.options import PipelineOptions
from tidemark.sources.csv import read_raw_csv
from tidemark.sources.layers import Layout

PRODUCTS = "ProductID,ProductDesc,ProductCategoryName,ProductSubCategoryName,Color,MakeFlag\n"
DETAIL = "SalesOrderID,SalesOrderDetailID,OrderQty,ProductID,UnitPrice,UnitPriceDiscount\n"
HEADER = "SalesOrderID,OrderDate,ShipDate,Freight,OnlineOrderFlag\n"


@pytest.fixture
def inbox(scratch):
    """Writes files into the three input folders, and tells the pipeline's arguments."""
    base = f"{scratch}/in"
    folders = {d: f"{base}/{d}" for d in (I.PRODUCTS, I.DETAIL, I.HEADER)}
    for f in folders.values():
        os.makedirs(f)

    def put(dataset, name, text):
        with open(f"{folders[dataset]}/{name}", "w") as out:
            out.write(text)

    put.folders, put.layout = folders, Layout(f"{scratch}/out")
    return put


def first_files(put):
    put(I.PRODUCTS, "p1.csv", PRODUCTS + "1,Chain,,Wheels,Red,true\n2,Cap,Clothing,Caps,,false\n")
    put(I.DETAIL, "d1.csv", DETAIL + "10,1,2,1,5.5,0.1\n10,2,1,2,3.25,0\n11,1,4,1,7,0.2\n99,1,1,1,1,0\n")
    put(I.HEADER, "h1.csv", HEADER + "10,2021-06-01,2021-06-08,1.5,TRUE\n11,2021-07,2021-07-09,2,false\n")


def full(spark, put, options=PipelineOptions()):
    raw = R.RawTables(*(read_raw_csv(spark, put.folders[d]) for d in (I.PRODUCTS, I.DETAIL, I.HEADER)))
    return R.build(raw, options)


def rows(df, columns=None):
    columns = columns or sorted(df.columns)
    return sorted((tuple(str(v) for v in r) for r in df.select(columns).collect()))


def same_as_full(spark, pipeline, put):
    layers = full(spark, put, pipeline.options)
    assert rows(pipeline.orders()) == rows(layers.publish_orders)
    assert rows(pipeline.product()) == rows(layers.publish_product)
    top, lead = pipeline.answers()
    assert rows(top) == rows(layers.top_color_by_year) and rows(lead) == rows(layers.avg_lead_by_category)


def pipeline(spark, put, options=PipelineOptions()):
    return I.IncrementalPipeline(spark, put.layout, put.folders, options)


def test_only_new_files_are_processed(spark, inbox):
    first_files(inbox)
    p = pipeline(spark, inbox)
    assert p.run().rows[1] == {
        "raw_products": 2, "raw_sales_order_detail": 4, "raw_sales_order_header": 2, "store_sales_order_detail": 4,
        "store_sales_order_header": 2, "publish_product": 2, "publish_orders": 3, "answer_state": 3,
    }
    same_as_full(spark, p, inbox)
    again = p.run()
    assert again.rows == {} and again.written == 0
    # a line for an early header, a header for an early line, a line and header of their own
    inbox(I.DETAIL, "d2.csv", DETAIL + "11,2,1,2,nan,0\n12,1,3,1,2.5,0\n")
    inbox(I.HEADER, "h2.csv", HEADER + "99,2022-01-03,2022-01-04,0,true\n12,2022-02-01,2022-02-01,1,1\n")
    assert p.run().rows[2] == {
        "raw_products": 0, "raw_sales_order_detail": 2, "raw_sales_order_header": 2, "store_sales_order_detail": 2,
        "store_sales_order_header": 2, "publish_product": 0, "publish_orders": 3, "answer_state": 2,
    }
    same_as_full(spark, p, inbox)


def test_changed_and_removed_files_are_retired(spark, inbox):
    first_files(inbox)
    inbox(I.DETAIL, "d2.csv", DETAIL + "11,7,1,2,4,0\n10,7,1,2,4,0\n")
    inbox(I.HEADER, "h2.csv", HEADER + "99,2022-01-03,2022-01-04,0,true\n")
    p = pipeline(spark, inbox)
    p.run()
    inbox(I.DETAIL, "d1.csv", DETAIL + "10,1,2,1,5.5,0.1\n10,2,3,2,3.25,0\n")
    os.unlink(f"{inbox.folders[I.HEADER]}/h2.csv")
    assert p.run().rows[2]["publish_orders"] == 2
    same_as_full(spark, p, inbox)
    inbox(I.HEADER, "h3.csv", HEADER + "99,2023-01-03,2023-01-10,0,true\n10,2021-06-01,2021-06-03,9,true\n")
    p.run()
    same_as_full(spark, p, inbox)


def test_later_product_file_changes_earlier_answers_without_their_lines(spark, inbox):
    first_files(inbox)
    p = pipeline(spark, inbox)
    p.run()
    inbox(I.PRODUCTS, "p2.csv", PRODUCTS + "3,Bell,Accessories,Bells,Blue,true\n")
    inbox(I.PRODUCTS, "p1.csv", PRODUCTS + "1,Chain,,Locks,Black,true\n2,Cap,Clothing,Caps,White,false\n")
    assert p.run().rows[2]["publish_orders"] == 0
    same_as_full(spark, p, inbox)


def test_columns_of_later_files_are_kept(spark, inbox):
    first_files(inbox)
    p = pipeline(spark, inbox)
    p.run()
    inbox(I.DETAIL, "d2.csv", DETAIL.strip() + ",CarrierTrackingNumber\n11,2,1,2,4,0, AB \n")
    p.run()
    got = {(r.SalesOrderID, r.SalesOrderDetailID): r.CarrierTrackingNumber for r in p.orders().collect()}
    assert got == {(10, 1): None, (10, 2): None, (11, 1): None, (11, 2): "AB"}


@pytest.mark.parametrize("step", ["store_detail", "partial_state"])
def test_stopped_run_goes_on_behind_its_last_whole_step(spark, inbox, monkeypatch, step):
    first_files(inbox)
    p = pipeline(spark, inbox)
    where = I if step == "partial_state" else R
    with monkeypatch.context() as m:
        m.setattr(where, step, lambda *a, **k: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError, match="killed"):
            p.run()
    inbox(I.DETAIL, "d2.csv", DETAIL + "11,2,1,2,4,0\n")  # comes meanwhile: a batch of its own
    with monkeypatch.context() as m:
        read = I.read_raw_csv
        m.setattr(I, "read_raw_csv", lambda s, files: read(s, files) if all("d2.csv" in f for f in files) else pytest.fail("raw is read again"))
        done = pipeline(spark, inbox).run().rows
    assert not any(k.startswith("raw_") for k in done[1]) and done[2]["raw_sales_order_detail"] == 1
    same_as_full(spark, p, inbox)


def test_step_that_was_written_but_not_committed_is_written_again(spark, inbox, monkeypatch):
    first_files(inbox)
    p = pipeline(spark, inbox)
    commit = p.manifest.commit

    def failing(batch, step, *rest):
        if step == "publish_orders":
            raise RuntimeError("killed")
        commit(batch, step, *rest)

    monkeypatch.setattr(p.manifest, "commit", failing)
    with pytest.raises(RuntimeError, match="killed"):
        p.run()
    with pytest.raises(ValueError, match="no batch is finished"):
        p.orders()
    p = pipeline(spark, inbox)
    assert p.run().rows[1] == {"publish_orders": 3, "answer_state": 3}
    same_as_full(spark, p, inbox)


def test_other_options_are_refused_and_imputed_run_equals_full(spark, inbox):
    first_files(inbox)
    imputed = PipelineOptions(price_mode="correct", impute_orderdate=True)
    p = pipeline(spark, inbox, imputed)
    p.run()
    same_as_full(spark, p, inbox)
    inbox(I.DETAIL, "d2.csv", DETAIL + "11,2,1,2,4,0\n")
    with pytest.raises(ValueError, match="were written with"):
        pipeline(spark, inbox).run()


def test_inputs_without_rows_or_lines(spark, inbox):
    inbox(I.PRODUCTS, "p1.csv", PRODUCTS)
    inbox(I.HEADER, "h1.csv", HEADER + "10,2021-06-01,2021-06-08,1.5,TRUE\n")
    inbox(I.DETAIL, "d0.csv", DETAIL)
    p = pipeline(spark, inbox)
    assert p.run().written == 2
    with pytest.raises(ValueError, match="no order lines"):
        p.orders()
    with pytest.raises(ValueError, match="inputs must name"):
        I.IncrementalPipeline(spark, inbox.layout, {"products": "x"})


def test_states_merge_in_any_split(spark):
    values = [(y, c, m, d) for y in (2020, None) for c in ("a", None) for m in (0.1, 0.2, 1e-9, None, 123456.789) for d in (1, None)]
    values += [(2020, "a", v, 3) for v in (float("nan"), float("inf"), 1e20)] + [(2021, "b", float("-inf"), None), (2022, "c", 1e9, 2), (2022, "c", -5e9, 2), (2023, "d", None, None)]
    df = spark.createDataFrame([(k % 4, *v) for k, v in enumerate(values)], "part int, y int, c string, amount double, lead int")
    parts = None
    for k in range(4):
        state = partial_state(df.where(F.col("part") == k), ["y", "c"], "amount", "lead")
        parts = state if parts is None else parts.unionByName(state)
    merged = merge_states(parts, ["y", "c"])
    assert rows(merged.select("y", "c", state_money("r"))) == rows(revenue_by(df, ["y", "c"], "amount", "r"))
    by_colour = merge_states(merged, ["c"]).select("c", state_mean("m"))
    assert rows(by_colour) == rows(mean_by(df, ["c"], "lead", "m"))


def test_command_line(spark, inbox, scratch):
    from tidemark.__main__ import main

    first_files(inbox)
    args = ["--incremental", "--data-dir", f"{scratch}/in", "--out", f"{scratch}/cli"]
    assert main(args, spark)["publish_orders"] == 3
    assert main(args, spark) == {}
    with pytest.raises(SystemExit):
        main([*args, "--checks"], spark)
