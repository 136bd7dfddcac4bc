"""Registered queries over the driver tables, each with its oracle SQL.

Every query reads whole tables (``lineitem``, ``orders``, ``part`` under
``sf_dir``) through the raw views of :mod:`tidemark.sources.tpch_roles` and
runs the pipeline operators on them. Keys match between :data:`QUERIES` and
:func:`oracle_sql`; computed columns carry the same names on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.cleanse import is_incomplete_date, parse_timestamp, strict_flag
from tidemark.operators import analysis, joins, quality
from tidemark.operators.typing import apply_roles, rejected_values
from tidemark.plans import oracle, registry_layers
from tidemark.plans import retail as R
from tidemark.plans.options import PipelineOptions, PriceMode
from tidemark.plans.pipeline import SAMPLE_FORMULA_COLUMNS, SAMPLE_ORDER_COLUMNS, sorted_sample
from tidemark.plans.retail import RawTables
from tidemark.sources.tpch_roles import raw_tables

Query = Callable[[SparkSession, str], DataFrame]

DEFAULT = PipelineOptions()
CORRECT = PipelineOptions(price_mode=PriceMode.CORRECT)
IMPUTED = PipelineOptions(impute_orderdate=True)


def _layers(spark: SparkSession, sf_dir: str, options: PipelineOptions = DEFAULT) -> R.Layers:
    """All layers, lazily."""
    return R.build(raw_tables(spark, sf_dir), options)


def _raw(spark: SparkSession, sf_dir: str) -> RawTables:
    """Raw text views over the whole driver tables."""
    return raw_tables(spark, sf_dir)


# ---------------------------------------------------------------- store layer


def q_clean_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = apply_roles(_raw(spark, sf_dir).products, R.PRODUCT_ROLES)
    return typed.select("ProductID", "ProductDesc", "Color", "ProductCategoryName", "ProductSubCategoryName")


def q_typed_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = apply_roles(_raw(spark, sf_dir).products, R.PRODUCT_ROLES)
    return typed.select("ProductID", "SafetyStockLevel", "ReorderPoint", "StandardCost", "ListPrice", "Weight")


def q_parse_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw(spark, sf_dir)
    prod = raw.products.select(F.lit("MakeFlag").alias("flag_column"), F.col("MakeFlag").alias("raw_text"))
    head = raw.header.select(F.lit("OnlineOrderFlag").alias("flag_column"), F.col("OnlineOrderFlag").alias("raw_text"))
    both = prod.unionByName(head)
    return both.groupBy("flag_column", "raw_text").agg(F.count(F.lit(1)).alias("rows")).select(
        "flag_column", "raw_text", strict_flag("raw_text").alias("parsed"), "rows"
    )


def q_product_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejected_values(_raw(spark, sf_dir).products, R.PRODUCT_ROLES)


def q_header_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    # OrderDate has its own repair rule (see incomplete_dates / orderdate_*).
    roles = {c: r for c, r in R.HEADER_ROLES.items() if c != "OrderDate"}
    return rejected_values(_raw(spark, sf_dir).header, roles)


def q_detail_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejected_values(_raw(spark, sf_dir).detail, R.DETAIL_ROLES)


def q_incomplete_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(spark, sf_dir).header.agg(
        F.count_if(is_incomplete_date("OrderDate")).alias("incomplete_orderdates"),
        F.count(F.lit(1)).alias("header_rows"),
    )


def _header_dates(options: PipelineOptions) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        sh = R.store_header(_raw(spark, sf_dir).header, options)
        return sh.select("SalesOrderID", "OrderDate", "ShipDate")

    return q


def q_dedupe_keep_populated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.store_products(_raw(spark, sf_dir).products)


def q_duplicate_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.product_profile(_raw(spark, sf_dir).products)


def q_timestamp_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header date texts, zoned ones included, and what they parse to."""
    h = _raw(spark, sf_dir).header
    return h.select(
        "SalesOrderID", F.col("OrderDate").alias("order_text"), parse_timestamp("OrderDate").alias("order_ts"),
        F.col("ShipDate").alias("ship_text"), parse_timestamp("ShipDate").alias("ship_ts"),
    )


# -------------------------------------------------------------- publish layer


def q_publish_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _layers(spark, sf_dir).publish_product


def _publish_orders(options: PipelineOptions) -> Query:
    return lambda spark, sf_dir: _layers(spark, sf_dir, options).publish_orders


def q_business_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    po = _layers(spark, sf_dir).publish_orders
    return po.select(
        "SalesOrderID", "SalesOrderDetailID", F.col("OrderDate").cast("date").alias("order_day"),
        F.col("ShipDate").cast("date").alias("ship_day"), R.LEAD,
    )


def q_lead_time_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.lead_time_edges(_layers(spark, sf_dir).publish_orders)


def q_price_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    po = _layers(spark, sf_dir).publish_orders
    return po.select("SalesOrderID", "SalesOrderDetailID", R.PRICE_SPEC, R.PRICE_CORRECT, R.PRICE_GAP)


# ------------------------------------------------------------------- analysis


def q_orders_with_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    owp = _layers(spark, sf_dir).orders_with_product
    return owp.select(
        "SalesOrderID", "SalesOrderDetailID", "ProductID", "Color", "ProductCategoryName",
        "OrderYear", R.PRICE, R.LEAD,
    )


def q_revenue_by_year_color(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.revenue_by_year_color(_layers(spark, sf_dir).orders_with_product)


def _top_color(options: PipelineOptions) -> Query:
    return lambda spark, sf_dir: _layers(spark, sf_dir, options).top_color_by_year


def _avg_lead(options: PipelineOptions) -> Query:
    return lambda spark, sf_dir: _layers(spark, sf_dir, options).avg_lead_by_category


def _coverage(options: PipelineOptions) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return analysis.coverage(_layers(spark, sf_dir, options).publish_orders, R.LEAD)

    return q


def _one_pass(which: int) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _layers(spark, sf_dir).answers()[which]

    return q


def q_formula_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    po = _layers(spark, sf_dir).publish_orders
    return analysis.formula_comparison(po, R.PRICE_SPEC, R.PRICE_CORRECT, R.PRICE_GAP)


def q_sample_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sorted_sample(_layers(spark, sf_dir).publish_orders, SAMPLE_ORDER_COLUMNS, 10)


def q_sample_formulas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sorted_sample(_layers(spark, sf_dir).publish_orders, SAMPLE_FORMULA_COLUMNS, 100)


def q_dq_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    L = _layers(spark, sf_dir)
    return R.integrity_checks(L.store_detail, L.store_header, L.publish_product, L.top_color_by_year, L.avg_lead_by_category)


def q_orphan_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw(spark, sf_dir)
    detail = apply_roles(raw.detail.select(R.ORDER_KEY, R.PRODUCT_KEY), R.DETAIL_ROLES)
    header = apply_roles(raw.header.select(R.ORDER_KEY), R.HEADER_ROLES)
    product = apply_roles(raw.products.select(R.PRODUCT_KEY), R.PRODUCT_ROLES)
    dims = {"lines_without_header": (header, R.ORDER_KEY), "lines_without_product": (product, R.PRODUCT_KEY)}
    return analysis.stacked(joins.orphan_counts(detail, dims), list(dims))


def q_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every dataset. Typing and enrichment keep rows, so the raw,
    stored and published sizes follow from one profile of the products and one
    count per order key; each source table is read once."""
    raw = _raw(spark, sf_dir)
    profile = R.product_profile(raw.products).select(
        F.col("total_rows").alias("raw_products"),
        (F.col("total_rows") - F.col("duplicate_rows")).alias("store_products"),
        (F.col("total_rows") - F.col("duplicate_rows")).alias("publish_product"),
    )
    keys = analysis.join_counts(
        apply_roles(raw.detail.select(R.ORDER_KEY), R.DETAIL_ROLES),
        apply_roles(raw.header.select(R.ORDER_KEY), R.HEADER_ROLES),
        R.ORDER_KEY,
    ).select(
        F.col("left_rows").alias("raw_sales_order_detail"),
        F.col("left_rows").alias("store_sales_order_detail"),
        F.col("right_rows").alias("raw_sales_order_header"),
        F.col("right_rows").alias("store_sales_order_header"),
        F.col("joined_rows").alias("publish_orders"),
    )
    return analysis.stacked(profile, profile.columns).unionByName(analysis.stacked(keys, keys.columns))


QUERIES: dict[str, Query] = {
    "clean_strings": q_clean_strings,
    "typed_cast": q_typed_cast,
    "parse_flags": q_parse_flags,
    "product_rejects": q_product_rejects,
    "header_rejects": q_header_rejects,
    "detail_rejects": q_detail_rejects,
    "incomplete_dates": q_incomplete_dates,
    "orderdate_null": _header_dates(DEFAULT),
    "orderdate_impute": _header_dates(IMPUTED),
    "dedupe_keep_populated": q_dedupe_keep_populated,
    "duplicate_profile": q_duplicate_profile,
    "timestamp_text": q_timestamp_text,
    "publish_product": q_publish_product,
    "publish_orders": _publish_orders(DEFAULT),
    "publish_orders_correct": _publish_orders(CORRECT),
    "business_days": q_business_days,
    "lead_time_edges": q_lead_time_edges,
    "price_diff": q_price_diff,
    "orders_with_product": q_orders_with_product,
    "revenue_by_year_color": q_revenue_by_year_color,
    "top_color_by_year": _top_color(DEFAULT),
    "top_color_by_year_imputed": _top_color(IMPUTED),
    "top_color_by_year_correct": _top_color(CORRECT),
    "avg_lead_by_category": _avg_lead(DEFAULT),
    "avg_lead_by_category_imputed": _avg_lead(IMPUTED),
    "top_color_by_year_one_pass": _one_pass(0),
    "avg_lead_by_category_one_pass": _one_pass(1),
    "lead_time_coverage": _coverage(DEFAULT),
    "lead_time_coverage_imputed": _coverage(IMPUTED),
    "formula_comparison": q_formula_comparison,
    "sample_orders": q_sample_orders,
    "sample_formulas": q_sample_formulas,
    "dq_checks": q_dq_checks,
    "orphan_lines": q_orphan_lines,
    "row_counts": q_row_counts,
    **registry_layers.QUERIES,
}


# ------------------------------------------------------------------ oracle SQL


def _with(body: str, options: PipelineOptions = DEFAULT) -> str:
    return oracle.prelude(options) + body


def _oracle_top_color(options: PipelineOptions) -> str:
    return _with(
        f"""
, rev AS (SELECT OrderYear, Color, {oracle.money_sum('TotalLineExtendedPrice')} AS Revenue
          FROM orders_with_product GROUP BY OrderYear, Color)
SELECT OrderYear, Color, Revenue FROM (
  SELECT *, row_number() OVER (PARTITION BY OrderYear
                               ORDER BY Revenue DESC NULLS LAST, Color ASC NULLS FIRST) AS rn
  FROM rev) WHERE rn = 1""",
        options,
    )


def _oracle_avg_lead(options: PipelineOptions) -> str:
    return _with(
        """
SELECT ProductCategoryName, avg(LeadTimeInBusinessDays) AS AvgLeadTimeInBusinessDays
FROM orders_with_product GROUP BY ProductCategoryName""",
        options,
    )


def _oracle_coverage(options: PipelineOptions) -> str:
    return _with(
        """
SELECT count(LeadTimeInBusinessDays) AS rows_with_value, count(*) AS total_rows,
       CASE WHEN count(*) > 0 THEN count(LeadTimeInBusinessDays) * 100.0 / count(*) ELSE 0.0 END AS pct_with_value
FROM publish_orders""",
        options,
    )


def _oracle_rejects(table: str, cols: dict[str, str]) -> str:
    typed = {
        "int": oracle._int, "long": oracle._long, "key": oracle._key, "double": oracle._dbl,
        "flag": oracle._flag, "timestamp": oracle._ts,
    }
    parts = ["count(*) AS rows"]
    for c, role in cols.items():
        parts.append(f"CAST(count_if({c} IS NOT NULL AND {typed[role](c)} IS NULL) AS BIGINT) AS {c}_rejected")
    return _with(f"\nSELECT {', '.join(parts)} FROM {table}")


def _order_by_all(cols) -> str:
    return ", ".join(f"{c} ASC NULLS FIRST" for c in cols)


_EDGES = """
, e AS (
  SELECT LeadTimeInBusinessDays AS lt, OrderDate, ShipDate,
         date_diff('day', CAST(OrderDate AS DATE), CAST(ShipDate AS DATE)) AS gap,
         isodow(CAST(OrderDate AS DATE)) AS wd
  FROM publish_orders)
SELECT name AS "check", CAST(violations AS BIGINT) AS violations, CAST(checked AS BIGINT) AS checked FROM (
  SELECT 'mon_to_wed' AS name, count_if(wd = 1 AND gap = 2 AND lt IS DISTINCT FROM 2) AS violations, count_if(wd = 1 AND gap = 2) AS checked FROM e
  UNION ALL SELECT 'fri_to_mon', count_if(wd = 5 AND gap = 3 AND lt IS DISTINCT FROM 1), count_if(wd = 5 AND gap = 3) FROM e
  UNION ALL SELECT 'same_day', count_if(gap = 0 AND lt IS DISTINCT FROM 0), count_if(gap = 0) FROM e
  UNION ALL SELECT 'seven_day_span', count_if(gap = 7 AND lt IS DISTINCT FROM 5), count_if(gap = 7) FROM e
  UNION ALL SELECT 'reversed', count_if(gap < 0 AND lt IS DISTINCT FROM 0), count_if(gap < 0) FROM e
  UNION ALL SELECT 'recomputed', count_if(OrderDate IS NOT NULL AND ShipDate IS NOT NULL AND lt IS DISTINCT FROM
                     len(list_filter(range(greatest(gap, 0)), lambda i: isodow(CAST(OrderDate AS DATE) + CAST(i AS INTEGER)) <= 5))),
                   count_if(OrderDate IS NOT NULL AND ShipDate IS NOT NULL) FROM e
)"""

_DQ = """
, c AS (
  SELECT (SELECT count(*) FROM publish_orders) AS pub_rows,
         (SELECT count(*) FROM store_detail) AS detail_rows,
         (SELECT count(*) FROM store_detail d WHERE NOT EXISTS
            (SELECT 1 FROM store_header h WHERE h.SalesOrderID = d.SalesOrderID)) AS no_header,
         (SELECT count_if(TotalOrderFreight < 0) FROM publish_orders) AS neg_freight,
         (SELECT count_if((TotalLineExtendedPrice < 0 AND OrderQty >= 0) OR (TotalLineExtendedPrice > 0 AND OrderQty < 0))
            FROM publish_orders) AS sign_bad,
         (SELECT count_if(isnan(TotalLineExtendedPrice) OR isinf(TotalLineExtendedPrice) OR TotalLineExtendedPrice >= 1e9
            OR TotalLineExtendedPrice <= -1e9) FROM publish_orders) AS unusual,
         (SELECT count_if(ShipDate < OrderDate) FROM publish_orders) AS reversed,
         (SELECT count_if(LeadTimeInBusinessDays IS NULL) FROM publish_orders) AS lead_missing,
         (SELECT count(*) FROM publish_product) AS product_rows),
n AS (
  SELECT (SELECT json_keys(to_json(t)) FROM publish_orders t LIMIT 1) AS order_cols,
         (SELECT json_keys(to_json(t)) FROM publish_product t LIMIT 1) AS product_cols,
         (SELECT json_keys(to_json(t)) FROM (SELECT OrderYear, Color, sum(TotalLineExtendedPrice) AS Revenue
            FROM orders_with_product GROUP BY ALL) t LIMIT 1) AS top_cols,
         (SELECT json_keys(to_json(t)) FROM (SELECT ProductCategoryName, avg(LeadTimeInBusinessDays) AS AvgLeadTimeInBusinessDays
            FROM orders_with_product GROUP BY ALL) t LIMIT 1) AS lead_cols),
need AS (
  SELECT ['LeadTimeInBusinessDays', 'TotalLineExtendedPrice', 'TotalOrderFreight'] AS order_need,
         ['ProductID', 'Color', 'ProductCategoryName'] AS product_need,
         ['OrderYear', 'Color', 'Revenue'] AS top_need,
         ['ProductCategoryName', 'AvgLeadTimeInBusinessDays'] AS lead_need)
SELECT name AS "check", CAST(violations AS BIGINT) AS violations, CAST(checked AS BIGINT) AS checked FROM (
  SELECT 'published_nonempty' AS name, CASE WHEN pub_rows = 0 THEN 1 ELSE 0 END AS violations, pub_rows AS checked FROM c
  UNION ALL SELECT 'negative_freight', neg_freight, pub_rows FROM c
  UNION ALL SELECT 'price_sign_mismatch', sign_bad, pub_rows FROM c
  UNION ALL SELECT 'unusual_price', unusual, pub_rows FROM c
  UNION ALL SELECT 'ship_before_order', reversed, pub_rows FROM c
  UNION ALL SELECT 'lead_time_missing', lead_missing, pub_rows FROM c
  UNION ALL SELECT 'join_row_change', abs(detail_rows - pub_rows), detail_rows FROM c
  UNION ALL SELECT 'lines_without_header', no_header, detail_rows FROM c
  UNION ALL SELECT 'publish_product_nonempty', CASE WHEN product_rows = 0 THEN 1 ELSE 0 END, product_rows FROM c
  UNION ALL SELECT 'required_columns', len(order_need) - len(list_intersect(order_need, order_cols)), len(order_need) FROM n, need
  UNION ALL SELECT 'publish_product_required_columns', len(product_need) - len(list_intersect(product_need, product_cols)),
    len(product_need) FROM n, need
  UNION ALL SELECT 'analysis_top_color_by_year_required_columns', len(top_need) - len(list_intersect(top_need, top_cols)),
    len(top_need) FROM n, need
  UNION ALL SELECT 'analysis_avg_lead_by_category_required_columns', len(lead_need) - len(list_intersect(lead_need, lead_cols)),
    len(lead_need) FROM n, need
)"""


def oracle_sql() -> dict[str, str]:
    product_cols = {
        "ProductID": "key", "MakeFlag": "flag", "SafetyStockLevel": "int", "ReorderPoint": "int",
        "StandardCost": "double", "ListPrice": "double", "Weight": "double",
    }
    header_cols = {
        "SalesOrderID": "key", "ShipDate": "timestamp", "OnlineOrderFlag": "flag",
        "CustomerID": "key", "SalesPersonID": "key", "Freight": "double",
    }
    detail_cols = {
        "SalesOrderID": "key", "SalesOrderDetailID": "key", "OrderQty": "int", "ProductID": "key",
        "UnitPrice": "double", "UnitPriceDiscount": "double",
    }
    sql = {
        "clean_strings": _with(
            "\nSELECT ProductID, ProductDesc, Color, ProductCategoryName, ProductSubCategoryName FROM typed_products"
        ),
        "typed_cast": _with(
            "\nSELECT ProductID, SafetyStockLevel, ReorderPoint, StandardCost, ListPrice, Weight FROM typed_products"
        ),
        "parse_flags": _with(
            f"""
, f AS (SELECT 'MakeFlag' AS flag_column, MakeFlag AS raw_text FROM raw_products
        UNION ALL SELECT 'OnlineOrderFlag', OnlineOrderFlag FROM raw_header)
SELECT flag_column, raw_text, {oracle._flag('raw_text')} AS parsed, count(*) AS rows
FROM f GROUP BY flag_column, raw_text"""
        ),
        "product_rejects": _oracle_rejects("raw_products", product_cols),
        "header_rejects": _oracle_rejects("raw_header", header_cols),
        "detail_rejects": _oracle_rejects("raw_detail", detail_cols),
        "incomplete_dates": _with(
            "\nSELECT CAST(count_if(length(OrderDate) = 7) AS BIGINT) AS incomplete_orderdates, count(*) AS header_rows"
            " FROM raw_header"
        ),
        "orderdate_null": _with("\nSELECT SalesOrderID, OrderDate, ShipDate FROM store_header"),
        "orderdate_impute": _with("\nSELECT SalesOrderID, OrderDate, ShipDate FROM store_header", IMPUTED),
        "dedupe_keep_populated": _with("\nSELECT * FROM store_products"),
        "duplicate_profile": _with(
            """
SELECT count(*) AS total_rows, count(DISTINCT ProductID) AS distinct_keys,
       CAST(count_if(ProductID IS NULL) AS BIGINT) AS null_keys,
       count(*) - (SELECT count(*) FROM store_products) AS duplicate_rows
FROM typed_products"""
        ),
        "timestamp_text": _with(
            f"""
SELECT SalesOrderID, OrderDate AS order_text,
       CASE WHEN length(OrderDate) = 7 THEN TRY_CAST(OrderDate || '-01' AS TIMESTAMP) ELSE {oracle._ts('OrderDate')} END AS order_ts,
       ShipDate AS ship_text, {oracle._ts('ShipDate')} AS ship_ts FROM raw_header"""
        ),
        "publish_product": _with("\nSELECT * FROM publish_product"),
        "publish_orders": _with("\nSELECT * FROM publish_orders"),
        "publish_orders_correct": _with("\nSELECT * FROM publish_orders", CORRECT),
        "business_days": _with(
            """
SELECT SalesOrderID, SalesOrderDetailID, CAST(OrderDate AS DATE) AS order_day,
       CAST(ShipDate AS DATE) AS ship_day, LeadTimeInBusinessDays FROM publish_orders"""
        ),
        "lead_time_edges": _with(_EDGES),
        "price_diff": _with(
            """
SELECT SalesOrderID, SalesOrderDetailID, TotalLineExtendedPrice_Spec, TotalLineExtendedPrice_Correct,
       PriceDiff_Pct FROM publish_orders"""
        ),
        "orders_with_product": _with(
            """
SELECT SalesOrderID, SalesOrderDetailID, ProductID, Color, ProductCategoryName, OrderYear,
       TotalLineExtendedPrice, LeadTimeInBusinessDays FROM orders_with_product"""
        ),
        "revenue_by_year_color": _with(
            f"""
SELECT OrderYear, Color, {oracle.money_sum('TotalLineExtendedPrice')} AS Revenue
FROM orders_with_product GROUP BY OrderYear, Color"""
        ),
        "top_color_by_year": _oracle_top_color(DEFAULT),
        "top_color_by_year_imputed": _oracle_top_color(IMPUTED),
        "top_color_by_year_correct": _oracle_top_color(CORRECT),
        "avg_lead_by_category": _oracle_avg_lead(DEFAULT),
        "avg_lead_by_category_imputed": _oracle_avg_lead(IMPUTED),
        "top_color_by_year_one_pass": _oracle_top_color(DEFAULT),
        "avg_lead_by_category_one_pass": _oracle_avg_lead(DEFAULT),
        "lead_time_coverage": _oracle_coverage(DEFAULT),
        "lead_time_coverage_imputed": _oracle_coverage(IMPUTED),
        "formula_comparison": _with(
            f"""
, s AS (
  SELECT {oracle.money_sum('TotalLineExtendedPrice_Spec')} AS Total_Spec,
         {oracle.money_sum('TotalLineExtendedPrice_Correct')} AS Total_Correct,
         {oracle.money_sum('PriceDiff_Pct')} / nullif(count(PriceDiff_Pct), 0) AS Avg_Diff_Pct,
         min(PriceDiff_Pct) + 0.0 AS Min_Diff_Pct,
         max(PriceDiff_Pct) + 0.0 AS Max_Diff_Pct,
         count(*) AS Total_Rows,
         CAST(sum(TRY_CAST(CAST(CASE WHEN fine THEN TotalLineExtendedPrice_Spec END AS VARCHAR) AS DECIMAL(38,18))) AS DOUBLE) AS Ordinary_Spec,
         CAST(sum(TRY_CAST(CAST(CASE WHEN fine THEN TotalLineExtendedPrice_Correct END AS VARCHAR) AS DECIMAL(38,18))) AS DOUBLE) AS Ordinary_Correct,
         CAST(count_if(NOT fine) AS BIGINT) AS Unusual_Lines
  FROM (SELECT *, abs(TotalLineExtendedPrice_Spec) < 1e9 AND abs(TotalLineExtendedPrice_Correct) < 1e9 AS fine FROM publish_orders))
SELECT *, Total_Correct - Total_Spec AS Diff_Amount,
       CASE WHEN Total_Spec <> 0 THEN (Total_Correct - Total_Spec) / Total_Spec * 100.0 ELSE 0.0 END AS Diff_Pct_Total
FROM s"""
        ),
        "sample_orders": _with(
            f"\nSELECT {', '.join(SAMPLE_ORDER_COLUMNS)} FROM publish_orders "
            f"ORDER BY {_order_by_all(SAMPLE_ORDER_COLUMNS)} LIMIT 10"
        ),
        "sample_formulas": _with(
            f"\nSELECT {', '.join(SAMPLE_FORMULA_COLUMNS)} FROM publish_orders "
            f"ORDER BY {_order_by_all(SAMPLE_FORMULA_COLUMNS)} LIMIT 100"
        ),
        "dq_checks": _with(_DQ),
        "orphan_lines": _with(
            """
SELECT 'lines_without_header' AS dataset,
       (SELECT count(*) FROM store_detail d WHERE NOT EXISTS
          (SELECT 1 FROM store_header h WHERE h.SalesOrderID = d.SalesOrderID)) AS rows
UNION ALL
SELECT 'lines_without_product',
       (SELECT count(*) FROM store_detail d WHERE NOT EXISTS
          (SELECT 1 FROM publish_product p WHERE p.ProductID = d.ProductID))"""
        ),
        "row_counts": _with(
            """
SELECT 'raw_products' AS dataset, (SELECT count(*) FROM raw_products) AS rows
UNION ALL SELECT 'raw_sales_order_detail', (SELECT count(*) FROM raw_detail)
UNION ALL SELECT 'raw_sales_order_header', (SELECT count(*) FROM raw_header)
UNION ALL SELECT 'store_products', (SELECT count(*) FROM store_products)
UNION ALL SELECT 'store_sales_order_detail', (SELECT count(*) FROM store_detail)
UNION ALL SELECT 'store_sales_order_header', (SELECT count(*) FROM store_header)
UNION ALL SELECT 'publish_product', (SELECT count(*) FROM publish_product)
UNION ALL SELECT 'publish_orders', (SELECT count(*) FROM publish_orders)"""
        ),
    }
    layers = registry_layers.oracle_sql(sql["publish_orders"], sql["top_color_by_year"], sql["avg_lead_by_category"], sql["publish_product"])
    return sql | layers
