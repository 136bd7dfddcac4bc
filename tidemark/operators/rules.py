"""Category rules as a table instead of code.

A rule table has ``priority int, kind string, pattern string, category string``:
kind ``exact`` wants the subcategory to equal the pattern, kind ``contains``
wants the lower-cased subcategory to hold the lower-cased pattern. The lowest
priority that matches wins. Rules are matched by equi-joins, so neither the rule
table nor the product table needs to fit anywhere.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.enrich import DEFAULT_CATEGORY_RULES, CategoryRule, is_blank

RULE_SCHEMA = "priority int, kind string, pattern string, category string"
EXACT, CONTAINS = "exact", "contains"


def rule_table(spark: SparkSession, rules: Sequence[CategoryRule] = DEFAULT_CATEGORY_RULES) -> DataFrame:
    """The rules of code as a rule table: a rule's patterns share its priority."""
    rows = [(k, kind, p, r.category) for k, r in enumerate(rules, 1) for kind, patterns in ((EXACT, r.exact), (CONTAINS, r.contains)) for p in patterns]
    return spark.createDataFrame(rows, RULE_SCHEMA)


def _fault() -> Column:
    """Why a rule can't be applied; NULL if it can."""
    return (
        F.when(F.col("priority").isNull(), "no priority")
        .when(F.col("kind").isNull() | ~F.col("kind").isin(EXACT, CONTAINS), "unknown kind")
        .when(F.col("pattern").isNull(), "no pattern")
        .when(F.col("category").isNull(), "no category")
    )


def invalid_rules(rules: DataFrame) -> DataFrame:
    """Rules that can't be applied, with the reason: they match nothing, and a caller may refuse them."""
    return rules.select("*", _fault().alias("reason")).where("reason is not null")


def _substrings(text: Column, length: int) -> Column:
    """All substrings of so many characters."""
    places = F.sequence(F.lit(1), F.length(text) - length + 1)
    return F.when(F.length(text) >= length, F.transform(places, lambda i: F.substring(text, i, F.lit(length)))).otherwise(F.array().cast("array<string>"))


def matched_categories(texts: DataFrame, column: str, rules: DataFrame) -> DataFrame:
    """``column, matched``: the winning category of each distinct text of ``column`` that a rule matches.

    Texts and exact patterns join on equality. For the other kind each text is
    cut into its substrings of the lengths that patterns have, which join on
    equality too; only distinct texts are cut. Equal priorities are settled by
    kind (``contains`` first), pattern and category.
    """
    usable = rules.where(_fault().isNull())
    distinct = texts.select(F.col(column).alias("text")).where("text is not null").distinct()
    exact = distinct.join(usable.where(F.col("kind") == EXACT), F.col("text") == F.col("pattern"))
    found = exact.select("text", "priority", "kind", "pattern", "category")

    parts = usable.where(F.col("kind") == CONTAINS).withColumn("low", F.lower("pattern"))
    # a number for each different length of a pattern reaches the driver
    lengths = sorted(r["n"] for r in parts.select(F.length("low").alias("n")).distinct().collect())
    if lengths:
        cuts = [_substrings(F.lower("text"), n) for n in lengths]
        pieces = distinct.select("text", F.explode(F.array_distinct(F.flatten(F.array(*cuts)))).alias("low"))
        found = found.unionByName(pieces.join(parts, "low").select("text", "priority", "kind", "pattern", "category"))
    best = F.min(F.struct("priority", "kind", "pattern", "category"))
    return found.groupBy("text").agg(best.alias("best")).select(F.col("text").alias(column), F.col("best.category").alias("matched"))


def fill_categories(products: DataFrame, rules: DataFrame, category: str = "ProductCategoryName", subcategory: str = "ProductSubCategoryName") -> DataFrame:
    """``products`` with blank categories filled by the rule table; a blank one without a match keeps its value."""
    blank = is_blank(category)
    matched = matched_categories(products.where(blank), subcategory, rules)
    filled = products.join(matched, subcategory, "left")
    return filled.select(*[F.when(blank & F.col("matched").isNotNull(), F.col("matched")).otherwise(F.col(c)).alias(c) if c == category else F.col(c) for c in products.columns])
