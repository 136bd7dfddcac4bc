"""Registered queries of the incremental, bucketed, rule-table and layer operators, with their oracle SQL."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.cleanse import Role
from tidemark.functions.enrich import MISSING_COLOR, fill_blank
from tidemark.operators.quarantine import REASONS, rejected_rows
from tidemark.operators.reconcile import reconcile
from tidemark.operators.rules import fill_categories, rule_table
from tidemark.plans import incremental, oracle
from tidemark.plans import retail as R
from tidemark.plans.options import PipelineOptions
from tidemark.sources import yearly
from tidemark.sources.bucketed import Buckets, bucketed_pair
from tidemark.sources.layers import Layout, shared_base
from tidemark.sources.tpch_roles import raw_tables

#: Deliveries that the incremental queries split the tables into, keys of a reconciled range, and the year of ``orders_of_year``.
DELIVERIES, RANGE_KEYS, YEAR = 3, 1000, 1995


def working_base(spark: SparkSession) -> str:
    """A new folder under the shared checkpoint folder, or a temporary one for a local session that has none."""
    name = f"tidemark-{uuid.uuid4().hex}"
    if spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.master", "local").partition("[")[0] != "local":
        return shared_base(spark, name)
    return f"file://{tempfile.mkdtemp(prefix=name)}"


def deliver(raw: R.RawTables, base: str) -> dict[str, str]:
    """Write the raw tables as CSV files under ``base``, each in deliveries by a hash of the row; the folders by dataset.

    A line and its header often come in different deliveries.
    """
    folders = {}
    for dataset, frame in ((incremental.PRODUCTS, raw.products), (incremental.DETAIL, raw.detail), (incremental.HEADER, raw.header)):
        part = F.pmod(F.xxhash64(F.lit(dataset), *frame.columns), F.lit(DELIVERIES))
        writer = frame.withColumn("delivery", part).write.option("header", "true").option("emptyValue", '""')
        writer = writer.option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
        writer.partitionBy("delivery").csv(f"{base}/{dataset}")
        folders[dataset] = f"{base}/{dataset}"
    return folders


_BUILT: dict[tuple[str, str], incremental.IncrementalPipeline] = {}


def delivered_pipeline(spark: SparkSession, sf_dir: str) -> incremental.IncrementalPipeline:
    """The incremental layers after a run for each delivery; built once for an application and data folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _BUILT:
        base = working_base(spark)
        folders = deliver(raw_tables(spark, sf_dir), f"{base}/in")
        pipeline = None
        for last in range(DELIVERIES):
            come = ",".join(map(str, range(last + 1)))
            inputs = {d: f"{f}/delivery={{{come}}}" for d, f in folders.items()}
            pipeline = incremental.IncrementalPipeline(spark, Layout(f"{base}/layers"), inputs)
            pipeline.run()
        _BUILT[key] = pipeline
    return _BUILT[key]


def q_incremental_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivered_pipeline(spark, sf_dir).orders()


def q_incremental_top_color(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivered_pipeline(spark, sf_dir).answers()[0]


def q_incremental_avg_lead(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivered_pipeline(spark, sf_dir).answers()[1]


def q_bucketed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published orders from bucketed store layers, or by the plain join where a bucket would be too large."""
    raw = raw_tables(spark, sf_dir)
    detail, header = R.store_detail(raw.detail), R.store_header(raw.header)
    names = tuple(f"tidemark_{x}_{uuid.uuid4().hex}" for x in ("detail", "header"))
    buckets = Buckets(R.ORDER_KEY, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return R.publish_orders(*(bucketed_pair(detail, header, names, working_base(spark), buckets) or (detail, header)))


def q_product_by_rule_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    products = R.store_products(raw_tables(spark, sf_dir).products)
    return fill_categories(products.withColumn("Color", fill_blank("Color", MISSING_COLOR)), rule_table(spark))


def q_rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_tables(spark, sf_dir)
    parts = [
        rejected_rows(raw.products, R.PRODUCT_ROLES, "products", R.PRODUCT_KEY),
        rejected_rows(raw.detail, R.DETAIL_ROLES, "detail", R.ORDER_KEY),
        rejected_rows(raw.header, R.HEADER_ROLES, "header", R.ORDER_KEY),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def q_orders_of_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{working_base(spark)}/orders_by_year"
    yearly.write_by_year(R.build(raw_tables(spark, sf_dir)).publish_orders, path)
    return yearly.read_years(spark, path, [YEAR])


def q_reconciled_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published orders of both date repairs compared by range of order keys."""
    raw = raw_tables(spark, sf_dir)
    plain, imputed = (R.build(raw, PipelineOptions(impute_orderdate=i)).publish_orders for i in (False, True))
    return reconcile(plain, imputed, R.ORDER_KEY, RANGE_KEYS)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "incremental_orders": q_incremental_orders,
    "incremental_top_color": q_incremental_top_color,
    "incremental_avg_lead": q_incremental_avg_lead,
    "bucketed_orders": q_bucketed_orders,
    "product_by_rule_table": q_product_by_rule_table,
    "rejected_rows": q_rejected_rows,
    "orders_of_year": q_orders_of_year,
    "reconciled_ranges": q_reconciled_ranges,
}


def _rejects(table: str, dataset: str, key: str, columns: "list[str]", roles: "dict[str, Role]") -> list[str]:
    month = "CASE WHEN length({0}) = 7 THEN TRY_CAST({0} || '-01' AS TIMESTAMP) ELSE {1} END"  # the first of a month, as the library parses it
    typed = {
        Role.INT: oracle._int, Role.KEY: oracle._key, Role.DOUBLE: oracle._dbl, Role.FLAG: oracle._flag,
        Role.TIMESTAMP: lambda c: f"({month.format(c, oracle._ts(c))})",
    }
    return [
        f"SELECT '{dataset}' AS dataset, {key} AS row_key, '{c}' AS column_name, {c} AS text, '{REASONS[roles[c]]}' AS reason"
        f" FROM {table} WHERE {c} IS NOT NULL AND {typed[roles[c]](c)} IS NULL"
        for c in columns
        if c in roles and roles[c] is not Role.TRIM
    ]


def oracle_sql(published: str, top: str, lead: str, product: str) -> dict[str, str]:
    """SQL by query; the arguments are the SQL of the full run's orders, answers and products."""
    with_ = oracle.prelude()
    product_columns = ["ProductID", "MakeFlag", "SafetyStockLevel", "ReorderPoint", "StandardCost", "ListPrice", "Weight"]
    detail_columns = ["SalesOrderID", "SalesOrderDetailID", "OrderQty", "ProductID", "UnitPrice", "UnitPriceDiscount"]
    header_columns = ["SalesOrderID", "OrderDate", "ShipDate", "OnlineOrderFlag", "CustomerID", "SalesPersonID", "Freight"]
    rejects = [
        *_rejects("raw_products", "products", "ProductID", product_columns, R.PRODUCT_ROLES),
        *_rejects("raw_detail", "detail", "SalesOrderID", detail_columns, R.DETAIL_ROLES),
        *_rejects("raw_header", "header", "SalesOrderID", header_columns, R.HEADER_ROLES),
    ]
    return {
        "incremental_orders": published,
        "incremental_top_color": top,
        "incremental_avg_lead": lead,
        "bucketed_orders": published,
        "product_by_rule_table": product,
        "rejected_rows": with_ + "\nUNION ALL ".join(rejects),
        "orders_of_year": with_ + f"SELECT *, CAST(year(OrderDate) AS INTEGER) AS OrderYear FROM publish_orders WHERE year(OrderDate) = {YEAR}",
        "reconciled_ranges": with_
        + f"""
, repaired AS (
  SELECT {oracle._key("SalesOrderID")} AS SalesOrderID, length(OrderDate) = 7 AND {oracle._ts("ShipDate")} IS NOT NULL AS differs FROM raw_header
), lines AS (
  SELECT CAST(floor(d.SalesOrderID / {RANGE_KEYS}.0) * {RANGE_KEYS} AS BIGINT) AS range_start, differs
  FROM store_detail d JOIN repaired r ON d.SalesOrderID = r.SalesOrderID
)
SELECT range_start, count(*) AS left_rows, count(*) AS right_rows, NOT bool_or(coalesce(differs, false)) AS same FROM lines GROUP BY range_start""",
    }
