"""Oracle SQL (DuckDB dialect) for every registered query.

Written independently of the DataFrame code: the same raw views, typing,
de-duplication and measures expressed as SQL over the driver's tables
(``lineitem``, ``orders``, ``part`` views). The business-day count uses a
different method from the library's closed form: full weeks times five plus
an explicit enumeration of the remaining (at most six) days.
"""

from __future__ import annotations

from tidemark.plans.options import PipelineOptions, PriceMode

# Fixed pattern shared with the library: integer part of a numeric text.
_INT_RX = r"^\s*([+-]?[0-9]+)([.][0-9]*)?\s*$"


def _int(expr: str, sqltype: str = "INTEGER") -> str:
    return f"TRY_CAST(regexp_extract({expr}, '{_INT_RX}', 1) AS {sqltype})"


def _long(expr: str) -> str:
    return _int(expr, "BIGINT")


def _key(expr: str) -> str:
    """Identifier: an integer, with a zero fraction at most."""
    return f"TRY_CAST(regexp_extract({expr}, '^\\s*([+-]?[0-9]+)([.]0*)?\\s*$', 1) AS BIGINT)"


def _dbl(expr: str) -> str:
    return f"TRY_CAST({expr} AS DOUBLE)"


def _flag(expr: str) -> str:
    return f"(CASE WHEN lower({expr}) = 'true' THEN true WHEN lower({expr}) = 'false' THEN false END)"


def _ts(expr: str) -> str:
    """Text as a timestamp; a text that ends in ``+hh:mm`` or ``-hh:mm`` is moved to UTC by hand."""
    moved = (
        f"TRY_CAST(left({expr}, length({expr}) - 6) AS TIMESTAMP)"
        f" - (CASE WHEN substring({expr}, length({expr}) - 5, 1) = '-' THEN -1 ELSE 1 END)"
        f" * (TRY_CAST(substring({expr}, length({expr}) - 4, 2) AS INTEGER) * 60 + TRY_CAST(right({expr}, 2) AS INTEGER))"
        f" * INTERVAL 1 MINUTE"
    )
    return f"(CASE WHEN regexp_matches({expr}, ':[0-9]{{2}}[+-][0-9]{{2}}:[0-9]{{2}}$') THEN {moved} ELSE TRY_CAST({expr} AS TIMESTAMP) END)"


_FLAG_CASE = (
    "CASE {k} % 7 WHEN 0 THEN 'TRUE' WHEN 1 THEN 'false' WHEN 2 THEN 'True' "
    "WHEN 3 THEN 'FALSE' WHEN 4 THEN '1' WHEN 5 THEN ' true' ELSE NULL END"
)

_SUBCATEGORY = (
    "CASE split_part(p_name, ' ', 2) WHEN 'anvil' THEN 'Gloves' WHEN 'bolt' THEN 'Helmets' "
    "WHEN 'gear' THEN 'Wheels' WHEN 'gizmo' THEN 'Road Frames' WHEN 'plate' THEN 'Locks' "
    "WHEN 'ring' THEN 'Socks' WHEN 'rod' THEN 'Mountain FRAMES' ELSE NULL END"
)

RAW_VIEWS = f"""
raw_detail AS (
  SELECT CASE WHEN l_orderkey % 499 = 3 THEN NULL WHEN l_orderkey % 491 = 5 THEN '-' || CAST(l_orderkey AS VARCHAR)
              ELSE CAST(l_orderkey AS VARCHAR) END AS SalesOrderID,
         CAST(l_linenumber AS VARCHAR) AS SalesOrderDetailID,
         CASE WHEN l_orderkey % 53 = 0 THEN '-' ELSE '' END || CAST(l_quantity AS VARCHAR) AS OrderQty,
         CASE l_partkey % 97 WHEN 1 THEN '-' || CAST(l_partkey AS VARCHAR) WHEN 2 THEN NULL
              WHEN 3 THEN CAST(l_partkey AS VARCHAR) || '.0' ELSE CAST(l_partkey AS VARCHAR) END AS ProductID,
         CASE WHEN (l_orderkey + l_linenumber) % 1009 = 1 AND year(l_shipdate) = 1996 THEN 'NaN'
              WHEN (l_orderkey + l_linenumber) % 1009 = 2 AND year(l_shipdate) = 1997 THEN 'Infinity'
              WHEN (l_orderkey + l_linenumber) % 1009 = 3 AND year(l_shipdate) = 1998 THEN '1e20'
              WHEN l_orderkey % 307 = 0 THEN '0.01'
              WHEN l_orderkey % 5 = 0 THEN CAST(l_extendedprice AS VARCHAR) || '1379'
              ELSE CAST(l_extendedprice AS VARCHAR) END AS UnitPrice,
         CASE WHEN l_orderkey % 211 = 0 THEN 'n/a' ELSE CAST(l_discount + 0.0 AS VARCHAR) END AS UnitPriceDiscount,
         ' ' || l_returnflag || l_linestatus || '-' || CAST(l_suppkey AS VARCHAR) || ' ' AS CarrierTrackingNumber
  FROM lineitem
),
shipped AS (
  SELECT *, o_orderdate + (o_orderkey % 11 - 1) * INTERVAL 1 DAY AS ship_ts, 0 AS copy FROM orders
  UNION ALL
  SELECT *, o_orderdate + (o_orderkey % 11 - 1) * INTERVAL 1 DAY, 1 FROM orders WHERE o_orderkey % 401 = 0
),
raw_header AS (
  SELECT CASE WHEN o_orderkey % 13 = 0 THEN ' ' || CAST(o_orderkey AS VARCHAR) || ' '
              ELSE CAST(o_orderkey AS VARCHAR) END AS SalesOrderID,
         CASE WHEN o_orderkey % 97 = 0 THEN strftime(o_orderdate, '%Y-%m')
              WHEN o_orderkey % 113 = 4 THEN strftime(o_orderdate, '%Y-%m-%d') || 'T23:30:00-05:00'
              WHEN o_orderkey % 7 = 0 THEN strftime(o_orderdate, '%Y-%m-%d')
              ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS OrderDate,
         CASE WHEN o_orderkey % 131 = 7 THEN 'soon'
              WHEN o_orderkey % 127 = 9 THEN strftime(ship_ts, '%Y-%m-%d') || ' 01:30:00+02:30'
              ELSE strftime(ship_ts, '%Y-%m-%d %H:%M:%S') END AS ShipDate,
         {_FLAG_CASE.format(k="o_orderkey")} AS OnlineOrderFlag,
         '  AW' || lpad(CAST(o_custkey AS VARCHAR), 8, '0') || ' ' AS AccountNumber,
         CASE WHEN o_orderkey % 71 = 0 THEN CAST(o_custkey AS VARCHAR) || '.5' ELSE CAST(o_custkey AS VARCHAR) END AS CustomerID,
         substring(o_orderpriority, 1, 1) AS SalesPersonID,
         CASE WHEN copy = 1 THEN '1.5' WHEN o_orderkey % 89 = 0 THEN 'n/a'
              WHEN o_orderkey % 83 = 2 THEN '-' || CAST(o_totalprice AS VARCHAR)
              ELSE CAST(o_totalprice AS VARCHAR) END AS Freight,
         ' PO' || o_orderstatus || CAST(o_orderkey AS VARCHAR) || ' ' AS PurchaseOrderNumber
  FROM shipped
),
raw_products AS (
  SELECT CAST(p_partkey AS VARCHAR) AS ProductID,
         ' ' || p_name || ' ' AS ProductDesc,
         p_brand AS ProductNumber,
         {_FLAG_CASE.format(k="p_partkey")} AS MakeFlag,
         CASE WHEN p_partkey % 17 = 0 THEN '   '
              WHEN p_partkey % 19 = 0 THEN NULL
              ELSE CASE split_part(p_name, ' ', 1) WHEN 'red' THEN 'Red' WHEN 'blue' THEN '  Blue '
                     WHEN 'cold' THEN 'White' WHEN 'hot' THEN 'Multi ' WHEN 'new' THEN 'Black'
                     WHEN 'old' THEN 'Silver' WHEN 'small' THEN 'Yellow' WHEN 'large' THEN 'Grey' ELSE NULL END
         END AS Color,
         CAST(p_size AS VARCHAR) AS SafetyStockLevel,
         CASE p_partkey % 4 WHEN 0 THEN '12.5' WHEN 1 THEN 'x' WHEN 2 THEN '99999999999'
              ELSE CAST(p_size * 3 AS VARCHAR) END AS ReorderPoint,
         CASE WHEN p_size % 10 = 0 THEN '' ELSE CAST(p_size AS VARCHAR) || '.75' END AS StandardCost,
         CAST(p_retailprice AS VARCHAR) AS ListPrice,
         CAST(p_size AS VARCHAR) AS Size,
         'CM ' AS SizeUnitMeasureCode,
         CAST(p_size AS VARCHAR) || 'e-1' AS Weight,
         'LB' AS WeightUnitMeasureCode,
         CASE WHEN p_partkey % 3 = 0 THEN (CASE WHEN p_partkey % 2 = 0 THEN NULL ELSE '  ' END)
              ELSE p_type END AS ProductCategoryName,
         CASE WHEN p_partkey % 11 = 0 THEN lower({_SUBCATEGORY}) ELSE {_SUBCATEGORY} END AS ProductSubCategoryName
  FROM part
  UNION ALL
  SELECT odd_id, p_name || ' (' || kind || ')', p_brand, 'false', 'Silver',
         CAST(p_size AS VARCHAR), '0', '1.5', CAST(p_retailprice AS VARCHAR), CAST(p_size AS VARCHAR),
         'CM ', NULL, 'LB',
         CASE WHEN p_partkey % 2 = 0 THEN NULL ELSE 'Legacy' END,
         CASE WHEN p_partkey % 11 = 0 THEN lower({_SUBCATEGORY}) ELSE {_SUBCATEGORY} END
  FROM (
    SELECT *, ' ' || CAST(p_partkey AS VARCHAR) AS odd_id, 'old' AS kind FROM part
    UNION ALL SELECT *, ' AB-' || CAST(p_partkey AS VARCHAR), 'code' FROM part WHERE p_partkey % 59 = 0
    UNION ALL SELECT *, '9999999999999999999' || CAST(p_partkey AS VARCHAR), 'long' FROM part WHERE p_partkey % 59 = 1
    UNION ALL SELECT *, CAST(p_partkey AS VARCHAR) || '.5', 'half' FROM part WHERE p_partkey % 59 = 2
    UNION ALL SELECT *, NULL, 'none' FROM part WHERE p_partkey % 59 = 3
  )
)"""

# Fixed values inside the SQL below: the category rules (Clothing, Accessories,
# Components lists and the 'frames' substring) and the 'N/A' colour.
TYPED_PRODUCTS = f"""
typed_products AS (
  SELECT {_key("ProductID")} AS ProductID,
         coalesce(CAST({_key("ProductID")} AS VARCHAR), 'text:' || trim(ProductID)) AS product,
         trim(ProductDesc) AS ProductDesc,
         ProductNumber,
         {_flag("MakeFlag")} AS MakeFlag,
         trim(Color) AS Color,
         {_int("SafetyStockLevel")} AS SafetyStockLevel,
         {_int("ReorderPoint")} AS ReorderPoint,
         {_dbl("StandardCost")} AS StandardCost,
         {_dbl("ListPrice")} AS ListPrice,
         Size, SizeUnitMeasureCode,
         {_dbl("Weight")} AS Weight,
         WeightUnitMeasureCode,
         trim(ProductCategoryName) AS ProductCategoryName,
         trim(ProductSubCategoryName) AS ProductSubCategoryName
  FROM raw_products
),
store_products AS (
  SELECT * EXCLUDE (rn, product) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY product
      ORDER BY CASE WHEN ProductCategoryName IS NULL OR ProductCategoryName = '' THEN 1 ELSE 0 END,
               ProductDesc NULLS FIRST, ProductNumber NULLS FIRST, MakeFlag NULLS FIRST,
               Color NULLS FIRST, SafetyStockLevel NULLS FIRST, ReorderPoint NULLS FIRST,
               StandardCost NULLS FIRST, ListPrice NULLS FIRST, Size NULLS FIRST,
               SizeUnitMeasureCode NULLS FIRST, Weight NULLS FIRST, WeightUnitMeasureCode NULLS FIRST,
               ProductCategoryName NULLS FIRST, ProductSubCategoryName NULLS FIRST) AS rn
    FROM typed_products) WHERE rn = 1
),
publish_product AS (
  SELECT ProductID, ProductDesc, ProductNumber, MakeFlag,
         CASE WHEN Color IS NULL OR Color = '' THEN 'N/A' ELSE Color END AS Color,
         SafetyStockLevel, ReorderPoint, StandardCost, ListPrice, Size, SizeUnitMeasureCode,
         Weight, WeightUnitMeasureCode,
         CASE
           WHEN (ProductCategoryName IS NULL OR ProductCategoryName = '')
                AND ProductSubCategoryName IN ('Gloves', 'Shorts', 'Socks', 'Tights', 'Vests') THEN 'Clothing'
           WHEN (ProductCategoryName IS NULL OR ProductCategoryName = '')
                AND ProductSubCategoryName IN ('Locks', 'Lights', 'Headsets', 'Helmets', 'Pedals', 'Pumps') THEN 'Accessories'
           WHEN (ProductCategoryName IS NULL OR ProductCategoryName = '')
                AND (ProductSubCategoryName IN ('Wheels', 'Saddles') OR contains(lower(ProductSubCategoryName), 'frames')) THEN 'Components'
           ELSE ProductCategoryName
         END AS ProductCategoryName,
         ProductSubCategoryName
  FROM store_products
)"""

TYPED_DETAIL = f"""
store_detail AS (
  SELECT {_key("SalesOrderID")} AS SalesOrderID,
         {_key("SalesOrderDetailID")} AS SalesOrderDetailID,
         {_int("OrderQty")} AS OrderQty,
         {_key("ProductID")} AS ProductID,
         {_dbl("UnitPrice")} AS UnitPrice,
         {_dbl("UnitPriceDiscount")} AS UnitPriceDiscount,
         trim(CarrierTrackingNumber) AS CarrierTrackingNumber
  FROM raw_detail
)"""


def typed_header(impute: bool) -> str:
    fix = f"CAST(CAST({_ts('ShipDate')} AS DATE) - 7 AS TIMESTAMP)" if impute else "CAST(NULL AS TIMESTAMP)"
    return f"""
store_header AS (
  SELECT {_key("SalesOrderID")} AS SalesOrderID,
         CASE WHEN length(OrderDate) = 7 THEN {fix} ELSE {_ts("OrderDate")} END AS OrderDate,
         {_ts("ShipDate")} AS ShipDate,
         {_flag("OnlineOrderFlag")} AS OnlineOrderFlag,
         trim(AccountNumber) AS AccountNumber,
         {_key("CustomerID")} AS CustomerID,
         {_key("SalesPersonID")} AS SalesPersonID,
         {_dbl("Freight")} AS Freight,
         trim(PurchaseOrderNumber) AS PurchaseOrderNumber
  FROM raw_header
)"""


def published(price_mode: PriceMode) -> str:
    official = "TotalLineExtendedPrice_Spec" if price_mode is PriceMode.SPEC else "TotalLineExtendedPrice_Correct"
    return f"""
joined AS (
  SELECT d.SalesOrderID, d.SalesOrderDetailID, d.OrderQty, d.ProductID, d.UnitPrice, d.UnitPriceDiscount,
         d.CarrierTrackingNumber, h.OrderDate, h.ShipDate, h.OnlineOrderFlag, h.AccountNumber,
         h.CustomerID, h.SalesPersonID, h.Freight AS TotalOrderFreight, h.PurchaseOrderNumber,
         CAST(h.OrderDate AS DATE) AS od,
         date_diff('day', CAST(h.OrderDate AS DATE), CAST(h.ShipDate AS DATE)) AS gap
  FROM store_detail d JOIN store_header h ON d.SalesOrderID = h.SalesOrderID
),
measured AS (
  SELECT * EXCLUDE (od, gap),
         CASE WHEN gap IS NULL THEN NULL
              WHEN gap <= 0 THEN 0
              ELSE CAST(5 * (gap // 7)
                        + len(list_filter(range(gap % 7), lambda i: isodow(od + CAST(i AS INTEGER)) <= 5))
                        AS INTEGER)
         END AS LeadTimeInBusinessDays,
         CAST(OrderQty AS DOUBLE) * (UnitPrice - UnitPriceDiscount) AS TotalLineExtendedPrice_Spec,
         CAST(OrderQty AS DOUBLE) * UnitPrice * (1.0 - UnitPriceDiscount) AS TotalLineExtendedPrice_Correct
  FROM joined
),
publish_orders AS (
  SELECT *,
         CASE WHEN TotalLineExtendedPrice_Spec <> 0
              THEN (TotalLineExtendedPrice_Correct - TotalLineExtendedPrice_Spec) / TotalLineExtendedPrice_Spec * 100.0
              ELSE 0.0 END AS PriceDiff_Pct,
         {official} AS TotalLineExtendedPrice
  FROM measured
),
orders_with_product AS (
  SELECT o.*, p.Color, p.ProductCategoryName, CAST(year(o.OrderDate) AS INTEGER) AS OrderYear
  FROM publish_orders o LEFT JOIN (SELECT ProductID, Color, ProductCategoryName FROM publish_product) p
    ON o.ProductID = p.ProductID
)"""


def prelude(options: PipelineOptions = PipelineOptions()) -> str:
    """``WITH`` clause defining every layer as a named subquery."""
    parts = [RAW_VIEWS, TYPED_PRODUCTS, TYPED_DETAIL, typed_header(options.impute_orderdate), published(options.price_mode)]
    return "WITH " + ",".join(p.strip("\n") for p in parts) + "\n"


def money_sum(expr: str) -> str:
    """Ordinary amounts by their shortest text as decimals, the others as doubles; NULL only if both have none."""
    fine = f"({expr} > -1e9 AND {expr} < 1e9)"
    exact = f"CAST(sum(TRY_CAST(CAST(CASE WHEN {fine} THEN {expr} END AS VARCHAR) AS DECIMAL(38,18))) AS DOUBLE)"
    odd = f"sum({expr}) FILTER ({expr} IS NOT NULL AND NOT {fine})"
    return f"(CASE WHEN {odd} IS NULL THEN {exact} WHEN {exact} IS NULL THEN {odd} ELSE {exact} + {odd} END)"
