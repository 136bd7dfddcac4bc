"""Line-price formulas and their relative gap, as column expressions."""

from __future__ import annotations

from enum import Enum

from pyspark.sql import Column
from pyspark.sql import functions as F


class PriceMode(str, Enum):
    """Which line-price formula becomes the official ``TotalLineExtendedPrice``.

    ``SPEC``: quantity * (price - discount), discount read as an amount.
    ``CORRECT``: quantity * price * (1 - discount), discount read as a rate.
    """

    SPEC = "spec"
    CORRECT = "correct"

    @classmethod
    def parse(cls, value: "PriceMode | str") -> "PriceMode":
        if isinstance(value, cls):
            return value
        try:
            return cls(str(value).strip().lower())
        except ValueError:
            allowed = ", ".join(m.value for m in cls)
            raise ValueError(f"price_mode must be one of {allowed}; got {value!r}") from None


def _c(c: "Column | str") -> Column:
    return F.col(c) if isinstance(c, str) else c


def line_price_amount(qty: "Column | str", price: "Column | str", discount: "Column | str") -> Column:
    """``qty * (price - discount)``: the discount is an amount per unit."""
    return _c(qty).cast("double") * (_c(price) - _c(discount))


def line_price_rate(qty: "Column | str", price: "Column | str", discount: "Column | str") -> Column:
    """``qty * price * (1 - discount)``: the discount is a rate."""
    return _c(qty).cast("double") * _c(price) * (F.lit(1.0) - _c(discount))


def pct_gap(base: "Column | str", other: "Column | str") -> Column:
    """``(other - base) / base * 100`` where ``base != 0``; otherwise 0.0.

    A NULL base makes the guard NULL, which falls through to 0.0 (the value
    enters averages as zero, as in the reference output).
    """
    b, o = _c(base), _c(other)
    return F.when(b != F.lit(0.0), (o - b) / b * F.lit(100.0)).otherwise(F.lit(0.0))


def official_price(mode: "PriceMode | str", amount_col: str, rate_col: str) -> Column:
    """Select the official line price column for the given mode."""
    return F.col(amount_col if PriceMode.parse(mode) is PriceMode.SPEC else rate_col)
