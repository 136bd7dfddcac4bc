"""Run the retail pipeline end to end with materialised layers.

raw (Parquet copy of the text input) -> store -> publish -> analysis, each
layer written as Parquet under one :class:`~tidemark.sources.layers.Layout`
and read back by the next. The written layers cut lineage (a lost executor
recomputes from the last written layer, not from the CSV input) and give
exact row counts for free (``Observation`` on each write).

The two analysis questions share one pass: a single grouping-sets aggregate
over the order-product join, so the join and the scan of published orders
run once for both answers.
"""

from __future__ import annotations

import threading
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.analysis import formula_comparison
from tidemark.operators.quality import lead_time_edges, table_checks
from tidemark.plans import retail as R
from tidemark.plans.options import PipelineOptions
from tidemark.sources.csv import write_single_csv
from tidemark.sources.layers import Layout, write_parquet

# Columns of the two sample exports, sorted on all of them (a total order).
SAMPLE_ORDER_COLUMNS = (
    "SalesOrderID", "SalesOrderDetailID", "OrderDate", "ShipDate", "ProductID", "OrderQty",
    "UnitPrice", "UnitPriceDiscount", "LeadTimeInBusinessDays", "TotalLineExtendedPrice",
    "TotalOrderFreight", "OnlineOrderFlag", "CustomerID",
)
SAMPLE_FORMULA_COLUMNS = (
    "SalesOrderID", "SalesOrderDetailID", "OrderQty", "UnitPrice", "UnitPriceDiscount",
    "TotalLineExtendedPrice_Spec", "TotalLineExtendedPrice_Correct", "PriceDiff_Pct",
)


def sorted_sample(df: DataFrame, cols: "tuple[str, ...]", n: int) -> DataFrame:
    """First n rows under a total order on the selected columns: a top-n
    (``TakeOrderedAndProject``), so only n rows per task leave the executors."""
    return df.select(*cols).orderBy(*[F.col(c).asc_nulls_first() for c in cols]).limit(n)


@dataclass
class RunResult:
    rows: dict[str, int] = field(default_factory=dict)
    paths: dict[str, str] = field(default_factory=dict)
    seconds: dict[str, float] = field(default_factory=dict)


def run(
    spark: SparkSession,
    raw: R.RawTables,
    layout: Layout,
    options: PipelineOptions = PipelineOptions(),
    export_dir: "str | None" = None,
    concurrent_jobs: int = 3,
    checks: bool = False,
) -> RunResult:
    """Write every layer under ``layout``; optionally export CSV reports.

    ``raw`` holds the three all-string frames (e.g. from
    :func:`tidemark.sources.csv.read_raw_csv`).

    Independent chains (product, order lines, order headers; then the
    exports) are submitted as concurrent Spark jobs from ``concurrent_jobs``
    driver threads, so one job's small tail stages overlap another's work.

    With ``checks``, the whole-table integrity checks of the published orders,
    the product table and both answers (``order_checks``) and the lead-time
    cases (``lead_time_edges``) are written to the quality layer.
    """
    res = RunResult()
    lock = threading.Lock()

    def put(layer: str, name: str, df: DataFrame) -> DataFrame:
        path = layout.path(layer, name)
        t0 = time.perf_counter()
        rows = write_parquet(df, path, name)
        with lock:
            res.rows[name] = rows
            res.seconds[name] = round(time.perf_counter() - t0, 3)
            res.paths[name] = path
        return spark.read.parquet(path)

    def product_chain() -> DataFrame:
        raw_products = put("raw", "raw_products", raw.products)
        store_products = put("store", "store_products", R.store_products(raw_products))
        return put("publish", "publish_product", R.publish_product(store_products))

    def detail_chain() -> DataFrame:
        raw_detail = put("raw", "raw_sales_order_detail", raw.detail)
        return put("store", "store_sales_order_detail", R.store_detail(raw_detail))

    def header_chain() -> DataFrame:
        raw_header = put("raw", "raw_sales_order_header", raw.header)
        return put("store", "store_sales_order_header", R.store_header(raw_header, options))

    with ThreadPoolExecutor(max_workers=max(1, concurrent_jobs)) as pool:
        fp, fd, fh = (pool.submit(f) for f in (product_chain, detail_chain, header_chain))
        store_detail, store_header = fd.result(), fh.result()
        orders = put("publish", "publish_orders", R.publish_orders(store_detail, store_header, options))
        product = fp.result()

        lines = R.orders_with_product(orders, product)
        groups = R.grouped_answers(lines).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            # Sequential on purpose: the first write computes and caches the
            # shared aggregate, the second reads the cache (one pass in total).
            top, lead = R.split_answers(groups)
            top = put("publish", "analysis_top_color_by_year", top)
            lead = put("publish", "analysis_avg_lead_by_category", lead)
        finally:
            groups.unpersist()

        if checks:
            answers = table_checks("analysis_top_color_by_year", top, R.REQUIRED_TOP_COLUMNS).unionByName(
                table_checks("analysis_avg_lead_by_category", lead, R.REQUIRED_LEAD_COLUMNS)
            )
            integrity = R.integrity_checks(store_detail, store_header, product, top, lead, options, answers)
            fq = [
                pool.submit(put, "quality", "order_checks", integrity),
                pool.submit(put, "quality", "lead_time_edges", lead_time_edges(orders)),
            ]
            for f in fq:
                f.result()

        if export_dir:
            t0 = time.perf_counter()
            base = export_dir.rstrip("/")
            jobs = [
                (top, "analysis_top_color_by_year.csv", ["OrderYear"]),
                (lead, "analysis_avg_lead_by_category.csv", ["ProductCategoryName"]),
                (sorted_sample(orders, SAMPLE_ORDER_COLUMNS, 10), "sample_publish_orders.csv", SAMPLE_ORDER_COLUMNS),
                (
                    sorted_sample(orders, SAMPLE_FORMULA_COLUMNS, 100),
                    "formula_comparison_sample.csv",
                    SAMPLE_FORMULA_COLUMNS,
                ),
                (formula_comparison(orders, R.PRICE_SPEC, R.PRICE_CORRECT, R.PRICE_GAP), "formula_comparison.csv", []),
            ]
            for f in [pool.submit(write_single_csv, df, f"{base}/{name}", keys) for df, name, keys in jobs]:
                f.result()
            res.seconds["csv_exports"] = round(time.perf_counter() - t0, 3)
    return res
