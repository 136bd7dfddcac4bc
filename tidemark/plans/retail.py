"""The retail pipeline as lazy DataFrame functions.

raw (all text) -> store (typed, de-duplicated) -> publish (enriched product,
measured order lines) -> analysis (top colour per year, lead time per
category). Each function returns a lazy DataFrame; nothing runs until a sink
or an action, and Catalyst prunes every output down to the columns it needs.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.calendar import business_days
from tidemark.functions.cleanse import Role, repaired_timestamp, typed
from tidemark.functions.enrich import MISSING_COLOR, category_from_rules, fill_blank, is_blank
from tidemark.functions.pricing import line_price_amount, line_price_rate, official_price, pct_gap
from tidemark.operators.analysis import duplicate_profile, mean_by, money_sum, revenue_by, top_by_group
from tidemark.operators.joins import join_dimension, lines_with_header
from tidemark.operators.keyed import keep_first_by_preference
from tidemark.operators.quality import missing_columns, numbered_headers, order_checks, table_checks
from tidemark.operators.typing import apply_roles
from tidemark.plans.options import PipelineOptions

# Column names and roles of the raw tables, applied only to
# columns that are present. Identifiers are 64-bit so keys past 2^31 survive.
PRODUCT_ROLES: Mapping[str, Role] = {
    "ProductID": Role.KEY,
    "ProductDesc": Role.TRIM,
    "ProductCategoryName": Role.TRIM,
    "ProductSubCategoryName": Role.TRIM,
    "Color": Role.TRIM,
    "SafetyStockLevel": Role.INT,
    "ReorderPoint": Role.INT,
    "StandardCost": Role.DOUBLE,
    "ListPrice": Role.DOUBLE,
    "Weight": Role.DOUBLE,
    "MakeFlag": Role.FLAG,
}
DETAIL_ROLES: Mapping[str, Role] = {
    "SalesOrderID": Role.KEY,
    "SalesOrderDetailID": Role.KEY,
    "ProductID": Role.KEY,
    "OrderQty": Role.INT,
    "UnitPrice": Role.DOUBLE,
    "UnitPriceDiscount": Role.DOUBLE,
    "CarrierTrackingNumber": Role.TRIM,
}
HEADER_ROLES: Mapping[str, Role] = {
    "SalesOrderID": Role.KEY,
    "CustomerID": Role.KEY,
    "ShipToAddressID": Role.KEY,
    "BillToAddressID": Role.KEY,
    "SalesPersonID": Role.KEY,
    "TerritoryID": Role.KEY,
    "OrderDate": Role.TIMESTAMP,
    "ShipDate": Role.TIMESTAMP,
    "SubTotal": Role.DOUBLE,
    "TaxAmt": Role.DOUBLE,
    "Freight": Role.DOUBLE,
    "TotalDue": Role.DOUBLE,
    "OnlineOrderFlag": Role.FLAG,
    "PurchaseOrderNumber": Role.TRIM,
    "AccountNumber": Role.TRIM,
}

# Column names of the published tables.
ORDER_KEY = "SalesOrderID"
PRODUCT_KEY = "ProductID"
LEAD = "LeadTimeInBusinessDays"
PRICE = "TotalLineExtendedPrice"
PRICE_SPEC = "TotalLineExtendedPrice_Spec"
PRICE_CORRECT = "TotalLineExtendedPrice_Correct"
PRICE_GAP = "PriceDiff_Pct"
FREIGHT_IN, FREIGHT_OUT = "Freight", "TotalOrderFreight"


@dataclass(frozen=True)
class RawTables:
    """Pipeline input: the three raw all-string tables."""

    products: DataFrame
    detail: DataFrame
    header: DataFrame


# ---------------------------------------------------------------- store layer


# Internal column: what tells products apart.
_DEDUPE_KEY = "__tidemark_product"


def product_key(raw_id: "Column | str") -> Column:
    """What tells products apart: the typed id, or the trimmed text where it is no id (NULL: a product of its own)."""
    text = F.col(raw_id) if isinstance(raw_id, str) else raw_id
    exact = typed(text, Role.KEY).cast("string")
    return F.coalesce(exact, F.concat(F.lit("text:"), F.trim(text)))


def typed_products(raw: DataFrame) -> DataFrame:
    """Typed products, duplicates included, with the column that tells them apart last."""
    return apply_roles(raw.withColumn(_DEDUPE_KEY, product_key(PRODUCT_KEY)), PRODUCT_ROLES)


def store_products(raw: DataFrame) -> DataFrame:
    """Typed products, one row per product.

    Ids are typed before de-duplication, so ' 1', '01' and '1' are one
    product; ids that are no integers ('AB-1', '12.5', overflow) stay apart by
    their text, with a NULL ProductID. Among duplicates the row with a category
    is kept; remaining ties are broken by the other columns, so the choice is
    deterministic.
    """
    rows = typed_products(raw)
    prefer = [F.when(is_blank("ProductCategoryName"), 1).otherwise(0)] if "ProductCategoryName" in rows.columns else []
    return keep_first_by_preference(rows, [_DEDUPE_KEY], prefer).drop(_DEDUPE_KEY)


def product_profile(raw: DataFrame) -> DataFrame:
    """Row counts of the raw products and of what de-duplication removes."""
    return duplicate_profile(typed_products(raw), PRODUCT_KEY, _DEDUPE_KEY)


def store_detail(raw: DataFrame) -> DataFrame:
    return apply_roles(raw, DETAIL_ROLES)


def store_header(raw: DataFrame, options: PipelineOptions = PipelineOptions()) -> DataFrame:
    """Typed headers; a month-only OrderDate becomes NULL or, with
    ``impute_orderdate``, ShipDate - 7 days (no eager count decides this)."""
    overrides = {}
    if "OrderDate" in raw.columns:
        ship = F.col("ShipDate") if "ShipDate" in raw.columns else F.lit(None).cast("string")
        overrides["OrderDate"] = repaired_timestamp(F.col("OrderDate"), ship, options.impute_orderdate)
    return apply_roles(raw, HEADER_ROLES, overrides)


# -------------------------------------------------------------- publish layer


def publish_product(products: DataFrame) -> DataFrame:
    """Colour blanks -> 'N/A'; blank categories filled from subcategory rules."""
    cols = []
    for c in products.columns:
        if c == "Color":
            cols.append(fill_blank("Color", MISSING_COLOR).alias(c))
        elif c == "ProductCategoryName" and "ProductSubCategoryName" in products.columns:
            cols.append(category_from_rules("ProductCategoryName", "ProductSubCategoryName").alias(c))
        else:
            cols.append(F.col(c))
    return products.select(*cols)


def measured_orders(joined: DataFrame, options: PipelineOptions = PipelineOptions(), freight: str = FREIGHT_IN) -> DataFrame:
    """Joined order lines with lead time, both price formulas, their percent
    gap and the official price; Freight is renamed in place."""
    base = [F.col(c).alias(FREIGHT_OUT) if c == freight else F.col(c) for c in joined.columns]
    spec = line_price_amount("OrderQty", "UnitPrice", "UnitPriceDiscount")
    correct = line_price_rate("OrderQty", "UnitPrice", "UnitPriceDiscount")
    measured = joined.select(
        *base,
        business_days("OrderDate", "ShipDate").alias(LEAD),
        spec.alias(PRICE_SPEC),
        correct.alias(PRICE_CORRECT),
    )
    return measured.select(
        "*",
        pct_gap(PRICE_SPEC, PRICE_CORRECT).alias(PRICE_GAP),
        official_price(options.price_mode, PRICE_SPEC, PRICE_CORRECT).alias(PRICE),
    )


def publish_orders(detail: DataFrame, header: DataFrame, options: PipelineOptions = PipelineOptions()) -> DataFrame:
    """Order lines joined to their header with lead time and prices.

    Columns: key, detail columns, header columns (Freight renamed
    TotalOrderFreight in place; a header column that the detail has too is
    prefixed ``Header_``), LeadTimeInBusinessDays, the two price formulas,
    their percent gap, and the official price of the chosen mode.
    """
    return measured_orders(lines_with_header(detail, header, ORDER_KEY), options)


# Columns that the published tables must carry.
REQUIRED_ORDER_COLUMNS = ("LeadTimeInBusinessDays", "TotalLineExtendedPrice", "TotalOrderFreight")
REQUIRED_PRODUCT_COLUMNS = ("ProductID", "Color", "ProductCategoryName")
REQUIRED_TOP_COLUMNS = ("OrderYear", "Color", "Revenue")
REQUIRED_LEAD_COLUMNS = ("ProductCategoryName", "AvgLeadTimeInBusinessDays")


def integrity_checks(
    detail: DataFrame,
    header: DataFrame,
    product: DataFrame,
    top: DataFrame,
    lead: DataFrame,
    options: PipelineOptions = PipelineOptions(),
    answers: "DataFrame | None" = None,
) -> DataFrame:
    """Whole-table checks of the published orders, the product table and both
    answers in one frame. The order lines are read once; pass the written
    answers (``answers``: a frame of ``check, violations, checked``) to check
    their rows too, else only their columns are checked, at plan time."""
    lines = lines_with_header(detail, numbered_headers(header, ORDER_KEY), ORDER_KEY, how="left")
    out = order_checks(measured_orders(lines, options), required=REQUIRED_ORDER_COLUMNS)
    out = out.unionByName(table_checks("publish_product", product, REQUIRED_PRODUCT_COLUMNS))
    if answers is not None:
        return out.unionByName(answers)
    plan_time = [
        ("analysis_top_color_by_year_required_columns", top, REQUIRED_TOP_COLUMNS),
        ("analysis_avg_lead_by_category_required_columns", lead, REQUIRED_LEAD_COLUMNS),
    ]
    rows = [F.struct(F.lit(n).alias("check"), F.lit(len(missing_columns(df, need))).cast("long").alias("violations"), F.lit(len(need)).cast("long").alias("checked")) for n, df, need in plan_time]
    return out.unionByName(detail.sparkSession.range(1).select(F.inline(F.array(*rows))))


# ------------------------------------------------------------------- analysis


def orders_with_product(orders: DataFrame, product: DataFrame) -> DataFrame:
    """Order lines with product Color and category (left join: lines without a
    product keep NULLs, distinct from the 'N/A' colour) and the order year."""
    dim = product.select(PRODUCT_KEY, "Color", "ProductCategoryName")
    out = join_dimension(orders, dim, PRODUCT_KEY, "left")
    return out.withColumn("OrderYear", F.year("OrderDate"))


def revenue_by_year_color(lines: DataFrame) -> DataFrame:
    return revenue_by(lines, ["OrderYear", "Color"], PRICE, out="Revenue")


def top_color_by_year(lines: DataFrame) -> DataFrame:
    """Colour with the highest revenue per order year (a NULL year is a group;
    ties go to the alphabetically first colour)."""
    return top_by_group(revenue_by_year_color(lines), ["OrderYear"], "Color", "Revenue", n=1)


def avg_lead_by_category(lines: DataFrame) -> DataFrame:
    return mean_by(lines, ["ProductCategoryName"], LEAD, out="AvgLeadTimeInBusinessDays")


def grouped_answers(lines: DataFrame) -> DataFrame:
    """Both analysis aggregates in one pass.

    ``GROUPING SETS ((OrderYear, Color), (ProductCategoryName))``: one scan,
    one shuffle. ``grouping_id`` tells the two sets apart, so NULL years,
    colours and categories stay ordinary group values. The result is small
    (years x colours + categories rows).
    """
    return lines.groupingSets(
        [["OrderYear", "Color"], ["ProductCategoryName"]],
        "OrderYear",
        "Color",
        "ProductCategoryName",
    ).agg(
        F.grouping_id().alias("_gid"),
        money_sum(PRICE).alias("Revenue"),
        F.avg(LEAD).alias("AvgLeadTimeInBusinessDays"),
    )


def split_answers(g: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(top colour per year, mean lead time per category) from
    :func:`grouped_answers`."""
    # _gid bits follow the listed columns: (year, colour) set -> 0b001, category set -> 0b110.
    revenue = g.filter(F.col("_gid") == 1).select("OrderYear", "Color", "Revenue")
    top = top_by_group(revenue, ["OrderYear"], "Color", "Revenue", n=1)
    lead = g.filter(F.col("_gid") == 6).select("ProductCategoryName", "AvgLeadTimeInBusinessDays")
    return top, lead


# ------------------------------------------------------------------ assembly


class Layers:
    """Every layer of one pipeline build as lazy DataFrames.

    Each layer is constructed on first access (and then reused), so a caller
    that needs only the published orders never constructs the product
    de-duplication or the analysis aggregates.
    """

    def __init__(self, raw: RawTables, options: PipelineOptions) -> None:
        self.raw, self.options = raw, options

    @cached_property
    def store_products(self) -> DataFrame:
        return store_products(self.raw.products)

    @cached_property
    def store_detail(self) -> DataFrame:
        return store_detail(self.raw.detail)

    @cached_property
    def store_header(self) -> DataFrame:
        return store_header(self.raw.header, self.options)

    @cached_property
    def publish_product(self) -> DataFrame:
        return publish_product(self.store_products)

    @cached_property
    def publish_orders(self) -> DataFrame:
        return publish_orders(self.store_detail, self.store_header, self.options)

    @cached_property
    def orders_with_product(self) -> DataFrame:
        return orders_with_product(self.publish_orders, self.publish_product)

    @cached_property
    def top_color_by_year(self) -> DataFrame:
        return top_color_by_year(self.orders_with_product)

    @cached_property
    def avg_lead_by_category(self) -> DataFrame:
        return avg_lead_by_category(self.orders_with_product)

    def answers(self) -> tuple[DataFrame, DataFrame]:
        """(top colour per year, mean lead per category) from one
        grouping-sets pass; persist the shared aggregate when both are used."""
        return split_answers(grouped_answers(self.orders_with_product))


def build(raw: RawTables, options: PipelineOptions = PipelineOptions()) -> Layers:
    """All layers as lazy DataFrames from the raw tables (see :class:`Layers`)."""
    return Layers(raw, options)
