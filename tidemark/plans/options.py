"""Run options of the retail pipeline (price formula, order-date repair)."""

from __future__ import annotations

from dataclasses import dataclass

from tidemark.functions.pricing import PriceMode

__all__ = ["PipelineOptions", "PriceMode"]


@dataclass(frozen=True)
class PipelineOptions:
    """Options of one pipeline build.

    ``impute_orderdate``: an incomplete OrderDate (7 characters, ``yyyy-MM``)
    becomes ShipDate - 7 days instead of NULL.
    """

    price_mode: PriceMode = PriceMode.SPEC
    impute_orderdate: bool = False

    def __post_init__(self) -> None:
        object.__setattr__(self, "price_mode", PriceMode.parse(self.price_mode))
        if not isinstance(self.impute_orderdate, bool):
            raise TypeError("impute_orderdate must be a bool")
