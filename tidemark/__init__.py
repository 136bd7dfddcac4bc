"""tidemark: layered retail order analytics composed from Spark DataFrame operators.

Raw all-string order data is typed tolerantly, product data is enriched from
rules, order lines are joined to their headers and measured (business-day lead
time, two price formulas and their gap), and grouped questions are answered.
Every step is a lazy ``DataFrame -> DataFrame`` or ``-> Column`` function so
Catalyst sees one plan per output.

    from tidemark import RawTables, PipelineOptions, build, run
"""

from tidemark.plans.options import PipelineOptions, PriceMode
from tidemark.plans.pipeline import RunResult, run
from tidemark.plans.retail import Layers, RawTables, build
from tidemark.sources.csv import read_raw_csv
from tidemark.sources.layers import Layout

__all__ = [
    "Layers",
    "Layout",
    "PipelineOptions",
    "PriceMode",
    "RawTables",
    "RunResult",
    "build",
    "read_raw_csv",
    "run",
]
