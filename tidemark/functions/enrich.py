"""Rule-driven product enrichment: blank fill and category from subcategory."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class CategoryRule:
    """Assign ``category`` when the subcategory equals one of ``exact``
    (case-sensitive) or, lower-cased, contains one of ``contains``."""

    category: str
    exact: tuple[str, ...] = ()
    contains: tuple[str, ...] = ()

    def matches(self, sub: Column) -> Column:
        conds = []
        if self.exact:
            conds.append(sub.isin(list(self.exact)))
        for word in self.contains:
            conds.append(F.lower(sub).contains(word.lower()))
        if not conds:
            return F.lit(False)
        out = conds[0]
        for c in conds[1:]:
            out = out | c
        return out


# The category rules of the published product table, tried in
# this order; the first match wins.
DEFAULT_CATEGORY_RULES: tuple[CategoryRule, ...] = (
    CategoryRule("Clothing", exact=("Gloves", "Shorts", "Socks", "Tights", "Vests")),
    CategoryRule("Accessories", exact=("Locks", "Lights", "Headsets", "Helmets", "Pedals", "Pumps")),
    CategoryRule("Components", exact=("Wheels", "Saddles"), contains=("frames",)),
)

# Fixed value: text that replaces a missing colour.
MISSING_COLOR = "N/A"


def _c(c: "Column | str") -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(c: "Column | str") -> Column:
    """NULL or the empty string."""
    col = _c(c)
    return col.isNull() | (col == F.lit(""))


def fill_blank(c: "Column | str", value: str) -> Column:
    """Replace NULL and ``''`` with ``value``."""
    return F.coalesce(F.nullif(_c(c), F.lit("")), F.lit(value))


def category_from_rules(
    category: "Column | str",
    subcategory: "Column | str",
    rules: Sequence[CategoryRule] = DEFAULT_CATEGORY_RULES,
) -> Column:
    """Fill a blank category from the first matching rule; otherwise keep it.

    A blank category without a match keeps its value (NULL stays NULL and ''
    stays ''), and a NULL subcategory matches no rule.
    """
    cat, sub = _c(category), _c(subcategory)
    blank = is_blank(cat)
    expr = None
    for rule in rules:
        cond = blank & rule.matches(sub)
        expr = F.when(cond, F.lit(rule.category)) if expr is None else expr.when(cond, F.lit(rule.category))
    return cat if expr is None else expr.otherwise(cat)
