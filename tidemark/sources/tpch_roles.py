"""Raw retail tables derived from the TPC-H style driver tables.

The driver tables are clean and typed; the pipeline starts from raw text. The
raw views render every column as text, the way a CSV export would, and inject
deterministic defects chosen by key arithmetic (padding, blanks, bad numbers,
odd flag words, month-only and zoned dates, unmatched, missing and repeated
keys, NaN, infinite and huge prices, negative amounts, ids that are none, a
duplicate of every product). No row is dropped:
every view covers its whole source table, so work grows with the data.

Role mapping:
  order detail  <- lineitem   (l_orderkey, l_linenumber, l_quantity, l_partkey,
                               l_extendedprice, l_discount)
  order header  <- orders     (o_orderkey, o_orderdate, o_custkey, o_totalprice
                               as freight) plus ShipDate = the order date and
                               -1 to 9 days, by key
  product       <- part       (colour and subcategory from the words of p_name,
                               category from p_type)

The oracle SQL builds the same views independently (see ``plans.oracle``).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# Text variants of the flag column, cycled by key (index = key % 7).
FLAG_TEXTS = ("TRUE", "false", "True", "FALSE", "1", " true", None)
# First word of p_name -> raw colour text.
# Keys divisible by 17 get a blank colour ('   '), by 19 a NULL one.
COLOR_TEXTS = {
    "red": "Red",
    "blue": "  Blue ",
    "cold": "White",
    "hot": "Multi ",
    "new": "Black",
    "old": "Silver",
    "small": "Yellow",
    "large": "Grey",
}
# Second word of p_name -> raw subcategory text (other words: NULL).
SUBCATEGORY_TEXTS = {
    "anvil": "Gloves",
    "bolt": "Helmets",
    "gear": "Wheels",
    "gizmo": "Road Frames",
    "plate": "Locks",
    "ring": "Socks",
    "rod": "Mountain FRAMES",
}
# ReorderPoint text by key % 4 (3 -> three times the size).
REORDER_TEXTS = ("12.5", "x", "99999999999")

def _text(c: Column) -> Column:
    return c.cast("string")


def _ts_text(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of a wall-clock timestamp. Casting keeps it free of
    the session time zone (``date_format`` would round-trip through it)."""
    return ts.cast("timestamp_ntz").cast("string")


def _day_text(ts: Column) -> Column:
    """``yyyy-MM-dd`` of a wall-clock timestamp."""
    return ts.cast("date").cast("string")


def _cycle(key: Column, texts: tuple, modulus: int | None = None) -> Column:
    """``texts[key % modulus]`` (modulus defaults to len(texts)); NULL past the end."""
    m = F.pmod(key, F.lit(modulus or len(texts)))
    expr = None
    for i, t in enumerate(texts):
        v = F.lit(t).cast("string")
        expr = F.when(m == i, v) if expr is None else expr.when(m == i, v)
    return expr


def _lookup(word: Column, table: dict[str, str]) -> Column:
    expr = None
    for k, v in table.items():
        expr = F.when(word == k, F.lit(v)) if expr is None else expr.when(word == k, F.lit(v))
    return expr.otherwise(F.lit(None).cast("string"))


def raw_detail(lineitem: DataFrame) -> DataFrame:
    k, part = F.col("l_orderkey"), F.col("l_partkey")
    price = _text(F.col("l_extendedprice"))
    line, shipped = F.pmod(k + F.col("l_linenumber"), F.lit(1009)), F.year("l_shipdate")
    return lineitem.select(
        F.when(F.pmod(k, F.lit(499)) == 3, F.lit(None).cast("string"))
        .when(F.pmod(k, F.lit(491)) == 5, F.concat(F.lit("-"), _text(k)))
        .otherwise(_text(k))
        .alias("SalesOrderID"),
        _text(F.col("l_linenumber")).alias("SalesOrderDetailID"),
        F.concat(F.when(F.pmod(k, F.lit(53)) == 0, F.lit("-")).otherwise(F.lit("")), _text(F.col("l_quantity"))).alias("OrderQty"),
        F.when(F.pmod(part, F.lit(97)) == 1, F.concat(F.lit("-"), _text(part)))
        .when(F.pmod(part, F.lit(97)) == 2, F.lit(None).cast("string"))
        .when(F.pmod(part, F.lit(97)) == 3, F.concat(_text(part), F.lit(".0")))
        .otherwise(_text(part))
        .alias("ProductID"),
        F.when((line == 1) & (shipped == 1996), F.lit("NaN"))
        .when((line == 2) & (shipped == 1997), F.lit("Infinity"))
        .when((line == 3) & (shipped == 1998), F.lit("1e20"))
        .when(F.pmod(k, F.lit(307)) == 0, F.lit("0.01"))
        .when(F.pmod(k, F.lit(5)) == 0, F.concat(price, F.lit("1379")))
        .otherwise(price)
        .alias("UnitPrice"),
        F.when(F.pmod(k, F.lit(211)) == 0, F.lit("n/a"))
        .otherwise(_text(F.col("l_discount") + F.lit(0.0)))
        .alias("UnitPriceDiscount"),
        F.concat(
            F.lit(" "), F.col("l_returnflag"), F.col("l_linestatus"), F.lit("-"), _text(F.col("l_suppkey")), F.lit(" ")
        )
        .alias("CarrierTrackingNumber"),
    )


def raw_header(orders: DataFrame) -> DataFrame:
    """Headers; every 401st comes twice. Ships -1 to 9 days after the order, by key."""
    k = F.col("o_orderkey")
    od = F.col("o_orderdate")
    copies = F.when(F.pmod(k, F.lit(401)) == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    days = F.make_dt_interval(days=(F.pmod(k, F.lit(11)) - 1).cast("int"))
    o = orders.select("*", F.explode(copies).alias("copy"), (od.cast("timestamp_ntz") + days).alias("ship_ts"))
    ship = F.col("ship_ts")
    return o.select(
        F.when(F.pmod(k, F.lit(13)) == 0, F.concat(F.lit(" "), _text(k), F.lit(" ")))
        .otherwise(_text(k))
        .alias("SalesOrderID"),
        F.when(F.pmod(k, F.lit(97)) == 0, F.substring(_day_text(od), 1, 7))
        .when(F.pmod(k, F.lit(113)) == 4, F.concat(_day_text(od), F.lit("T23:30:00-05:00")))
        .when(F.pmod(k, F.lit(7)) == 0, _day_text(od))
        .otherwise(_ts_text(od))
        .alias("OrderDate"),
        F.when(F.pmod(k, F.lit(131)) == 7, F.lit("soon"))
        .when(F.pmod(k, F.lit(127)) == 9, F.concat(_day_text(ship), F.lit(" 01:30:00+02:30")))
        .otherwise(_ts_text(ship))
        .alias("ShipDate"),
        _cycle(k, FLAG_TEXTS).alias("OnlineOrderFlag"),
        F.concat(F.lit("  AW"), F.lpad(_text(F.col("o_custkey")), 8, "0"), F.lit(" ")).alias("AccountNumber"),
        F.concat(_text(F.col("o_custkey")), F.when(F.pmod(k, F.lit(71)) == 0, F.lit(".5")).otherwise(F.lit(""))).alias("CustomerID"),
        F.substring(F.col("o_orderpriority"), 1, 1).alias("SalesPersonID"),
        F.when(F.col("copy") == 1, F.lit("1.5"))
        .when(F.pmod(k, F.lit(89)) == 0, F.lit("n/a"))
        .when(F.pmod(k, F.lit(83)) == 2, F.concat(F.lit("-"), _text(F.col("o_totalprice"))))
        .otherwise(_text(F.col("o_totalprice")))
        .alias("Freight"),
        F.concat(F.lit(" PO"), F.col("o_orderstatus"), _text(k), F.lit(" ")).alias("PurchaseOrderNumber"),
    )


def _subcategory(p_name: Column, key: Column) -> Column:
    sub = _lookup(F.split_part(p_name, F.lit(" "), F.lit(2)), SUBCATEGORY_TEXTS)
    return F.when(F.pmod(key, F.lit(11)) == 0, F.lower(sub)).otherwise(sub)


def raw_products(part: DataFrame) -> DataFrame:
    """Two rows for every part, and for some a third with an id that is none; the parts are read once.

    Only the row's number is exploded. Spark takes a generator's output to be as
    large as its input, so wide rows out of a generator make what is selected
    from them look far smaller than it is, and a large side would be broadcast.
    """
    k, name, size, row = F.col("p_partkey"), F.col("p_name"), F.col("p_size"), F.col("copy")

    # Every part also appears as a second, older product row (ids padded, so
    # they collide only after typing); de-duplication must pick one. Ids that
    # type to nothing must all survive it.
    turn = F.pmod(k, F.lit(59))
    numbers = F.when(turn < 4, F.array(F.lit(0), F.lit(1), F.lit(2))).otherwise(F.array(F.lit(0), F.lit(1)))

    def by_row(current: Column, older: Column) -> Column:
        return F.when(row == 0, current).otherwise(older)

    def by_kind(old: Column, code: Column, long: Column, half: Column, none: Column) -> Column:
        return F.when(row == 1, old).when(turn == 0, code).when(turn == 1, long).when(turn == 2, half).otherwise(none)

    text = F.lit(None).cast("string")
    older_id = by_kind(
        F.concat(F.lit(" "), _text(k)),
        F.concat(F.lit(" AB-"), _text(k)),
        F.concat(F.lit("9999999999999999999"), _text(k)),
        F.concat(_text(k), F.lit(".5")),
        text,
    )
    kind = by_kind(*(F.lit(f" ({x})") for x in ("old", "code", "long", "half", "none")))
    color = (
        F.when(F.pmod(k, F.lit(17)) == 0, F.lit("   "))
        .when(F.pmod(k, F.lit(19)) == 0, text)
        .otherwise(_lookup(F.split_part(name, F.lit(" "), F.lit(1)), COLOR_TEXTS))
    )
    reorder = F.when(F.pmod(k, F.lit(4)) < len(REORDER_TEXTS), _cycle(k, REORDER_TEXTS, modulus=4)).otherwise(_text(size * 3))
    cost = F.when(F.pmod(size, F.lit(10)) == 0, F.lit("")).otherwise(F.concat(_text(size), F.lit(".75")))
    even = F.pmod(k, F.lit(2)) == 0
    category = F.when(F.pmod(k, F.lit(3)) == 0, F.when(even, text).otherwise(F.lit("  "))).otherwise(F.col("p_type"))
    return part.select("*", F.explode(numbers).alias("copy")).select(
        by_row(_text(k), older_id).alias("ProductID"),
        by_row(F.concat(F.lit(" "), name, F.lit(" ")), F.concat(name, kind)).alias("ProductDesc"),
        F.col("p_brand").alias("ProductNumber"),
        by_row(_cycle(k, FLAG_TEXTS), F.lit("false")).alias("MakeFlag"),
        by_row(color, F.lit("Silver")).alias("Color"),
        _text(size).alias("SafetyStockLevel"),
        by_row(reorder, F.lit("0")).alias("ReorderPoint"),
        by_row(cost, F.lit("1.5")).alias("StandardCost"),
        _text(F.col("p_retailprice")).alias("ListPrice"),
        _text(size).alias("Size"),
        F.lit("CM ").alias("SizeUnitMeasureCode"),
        by_row(F.concat(_text(size), F.lit("e-1")), text).alias("Weight"),
        F.lit("LB").alias("WeightUnitMeasureCode"),
        by_row(category, F.when(even, text).otherwise(F.lit("Legacy"))).alias("ProductCategoryName"),
        _subcategory(name, k).alias("ProductSubCategoryName"),
    )


class DriverRawTables:
    """The three raw views over the driver tables under ``sf_dir``, each
    built on first access (a query touching only headers never reads
    ``part``). Same attributes as :class:`~tidemark.plans.retail.RawTables`."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def _scan(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{table}.parquet")

    @cached_property
    def products(self) -> DataFrame:
        return raw_products(self._scan("part"))

    @cached_property
    def detail(self) -> DataFrame:
        return raw_detail(self._scan("lineitem"))

    @cached_property
    def header(self) -> DataFrame:
        return raw_header(self._scan("orders"))


def raw_tables(spark: SparkSession, sf_dir: str) -> DriverRawTables:
    return DriverRawTables(spark, sf_dir)
