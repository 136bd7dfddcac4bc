"""The retail pipeline over input that arrives in files: only new files are processed.

A batch takes in the files that are new or changed since the last one. Every
layer keeps its batches in folders of their own (``batch=<number>``), and every
row the version of the file that it came from, so a changed or removed file is
retired by its version and no row is rewritten. A step that ends is committed to
the manifest; a run that was stopped is taken up behind its last whole step.

Order lines join headers of any batch: new lines meet all headers, lines of
earlier batches meet the new headers. The answers come from partial states by
year and product, one state table a batch, merged when they are read.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.analysis import top_by_group
from tidemark.operators.partials import merge_states, partial_state, state_mean, state_money
from tidemark.plans import retail as R
from tidemark.plans.options import PipelineOptions
from tidemark.sources.csv import read_raw_csv
from tidemark.sources.layers import Layout, write_parquet
from tidemark.sources.manifest import CURRENT, Manifest, file_version

PRODUCTS, DETAIL, HEADER = "products", "sales_order_detail", "sales_order_header"
VERSION, DETAIL_VERSION, HEADER_VERSION = "__version", "__detail_version", "__header_version"
STATE_GROUP = ("OrderYear", R.PRODUCT_KEY)
#: Steps of a batch in their order; the state comes last and finishes it.
STEPS = (
    *(f"raw_{d}" for d in (PRODUCTS, DETAIL, HEADER)),
    f"store_{DETAIL}",
    f"store_{HEADER}",
    "publish_product",
    "publish_orders",
    "answer_state",
)
LAYER = {"raw": "raw", "store": "store", "publish": "publish", "answer": "publish"}


@dataclass
class BatchResult:
    """What one run wrote: rows by step of each batch it worked on. Empty: nothing was new."""

    rows: dict[int, dict[str, int]] = field(default_factory=dict)

    @property
    def written(self) -> int:
        return sum(n for steps in self.rows.values() for n in steps.values())


class IncrementalPipeline:
    """Layers under ``layout`` that follow the files under ``inputs`` (dataset -> folder of CSV files with a header)."""

    def __init__(self, spark: SparkSession, layout: Layout, inputs: Mapping[str, str], options: PipelineOptions = PipelineOptions()) -> None:
        if set(inputs) != {PRODUCTS, DETAIL, HEADER}:
            raise ValueError(f"inputs must name {PRODUCTS}, {DETAIL} and {HEADER}; got {sorted(inputs)}")
        self.spark, self.layout, self.inputs, self.options = spark, layout, dict(inputs), options
        self.manifest = Manifest(spark, layout)

    # ------------------------------------------------------------- reading

    def _path(self, step: str, batch: "int | None" = None) -> str:
        path = self.layout.path(LAYER[step.split("_")[0]], step)
        return path if batch is None else f"{path}/batch={batch}"

    def _batches(self, step: str, upto: int) -> list[int]:
        """Batches that have rows of a step."""
        return [b for b, rows in self.manifest.batches(step).items() if b <= upto and rows]

    def _read(self, step: str, upto: int, versions: tuple[str, ...], first: int = 1, last: "int | None" = None) -> "DataFrame | None":
        """Rows of a step from the batches ``first`` to ``last`` (else ``upto``), without those of versions retired up to ``upto``.

        Columns that only some batches have are NULL in the others.
        """
        chosen = [b for b in self._batches(step, upto if last is None else last) if b >= first]
        if not chosen:
            return None
        rows = self.spark.read.option("mergeSchema", "true").parquet(*[self._path(step, b) for b in chosen])
        if self.manifest.retiring(upto):
            gone = self.manifest.retired(upto)
            for version in versions:
                rows = rows.join(gone.select(F.col("version").alias(version)), version, "left_anti")
        return rows

    # ------------------------------------------------------------- writing

    def run(self) -> BatchResult:
        """Finish a batch that an earlier run left, then take in what is new. Writes nothing where nothing is."""
        result = BatchResult()
        self.manifest.refresh()
        last = self.manifest.last_planned()
        if last and (done := self._finish(last)):
            result.rows[last] = done
        if self.manifest.plan(last + 1, self.manifest.changes(self.inputs)):
            result.rows[last + 1] = self._finish(last + 1)
        return result

    def _finish(self, batch: int) -> dict[str, int]:
        """Write the steps of a batch that are not committed yet, in order; rows by step."""
        done = self.manifest.committed(batch)
        self._check_options()
        written: dict[str, int] = {}
        makers: dict[str, Callable[[int], "DataFrame | None"]] = {
            **{f"raw_{d}": lambda b, d=d: self._raw(b, d) for d in (PRODUCTS, DETAIL, HEADER)},
            f"store_{DETAIL}": lambda b: self._store(b, DETAIL, R.store_detail),
            f"store_{HEADER}": lambda b: self._store(b, HEADER, lambda raw: R.store_header(raw, self.options)),
            "publish_product": self._product,
            "publish_orders": self._orders,
            "answer_state": self._state,
        }
        for step in STEPS:
            if step in done:
                continue
            frame = makers[step](batch)
            rows = 0 if frame is None else write_parquet(frame, self._path(step, batch), step)
            self.manifest.commit(batch, step, rows, repr(self.options))
            written[step] = rows
        return written

    def _check_options(self) -> None:
        other = self.manifest.options() - {repr(self.options)}
        if other:
            raise ValueError(f"the layers were written with {min(other)}, not {self.options!r}")

    def _raw(self, batch: int, dataset: str) -> "DataFrame | None":
        if not self.manifest.touched(batch, dataset, CURRENT):
            return None
        return read_raw_csv(self.spark, self.manifest.new_files(batch, dataset)).select("*", file_version(dataset).alias(VERSION))

    def _own(self, step: str, batch: int) -> "DataFrame | None":
        return self._read(step, batch, (), first=batch)

    def _store(self, batch: int, dataset: str, typed: Callable[[DataFrame], DataFrame]) -> "DataFrame | None":
        raw = self._own(f"raw_{dataset}", batch)
        return None if raw is None else typed(raw)

    def _product(self, batch: int) -> "DataFrame | None":
        """The whole product table where a batch has other products: a dimension, de-duplicated over all its files."""
        if not self.manifest.touched(batch, PRODUCTS):
            return None
        raw = self._read(f"raw_{PRODUCTS}", batch, (VERSION,))
        return None if raw is None else R.publish_product(R.store_products(raw.drop(VERSION)))

    def _orders(self, batch: int) -> "DataFrame | None":
        """Order lines that a batch adds: its lines with all headers, and earlier lines with its headers."""

        detail, header = f"store_{DETAIL}", f"store_{HEADER}"
        pairs = [
            (self._own(detail, batch), self._read(header, batch, (VERSION,))),
            (self._read(detail, batch, (VERSION,), last=batch - 1), self._own(header, batch)),
        ]
        out = None
        for d, h in pairs:
            if d is None or h is None:
                continue
            orders = R.publish_orders(d.withColumnRenamed(VERSION, DETAIL_VERSION), h.withColumnRenamed(VERSION, HEADER_VERSION), self.options)
            out = orders if out is None else out.unionByName(orders, allowMissingColumns=True)
        return out

    def _state(self, batch: int) -> "DataFrame | None":
        """Partial state of the lines that a batch adds; of all lines where it retires some, as sums hold no single line."""
        versions = (DETAIL_VERSION, HEADER_VERSION)
        retires = batch in self.manifest.retiring(batch)
        orders = self._read("publish_orders", batch, versions) if retires else self._own("publish_orders", batch)
        if orders is None:
            return None
        return partial_state(orders.withColumn("OrderYear", F.year("OrderDate")), STATE_GROUP, R.PRICE, R.LEAD)

    # ------------------------------------------------------------- results

    def _finished(self) -> int:
        self.manifest.refresh()
        done = self.manifest.batches(STEPS[-1])
        if not done:
            raise ValueError("no batch is finished yet")
        return max(done)

    def orders(self) -> DataFrame:
        """Published order lines of all finished batches, as a run over all files would publish them."""
        rows = self._read("publish_orders", self._finished(), (DETAIL_VERSION, HEADER_VERSION))
        if rows is None:
            raise ValueError("no order lines were published")
        return rows.drop(DETAIL_VERSION, HEADER_VERSION)

    def product(self) -> DataFrame:
        """The product table of the last finished batch that has other products."""
        snapshots = self._batches("publish_product", self._finished())
        return self.spark.read.parquet(self._path("publish_product", snapshots[-1]))

    def state(self) -> DataFrame:
        """Merged state by year and product, from the last batch that retired versions on."""
        finished = self._finished()
        rebuilt = self.manifest.retiring(finished)
        states = self._read("answer_state", finished, (), first=rebuilt[-1] if rebuilt else 1)
        if states is None:
            raise ValueError("no order lines were published")
        return merge_states(states, STATE_GROUP)

    def answers(self) -> tuple[DataFrame, DataFrame]:
        """(top colour per year, mean lead time per category) from the merged states: no order line is read."""
        return answers_from_state(self.state(), self.product())


def answers_from_state(state: DataFrame, product: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both answers from states by year and product and the product table of today."""
    dim = product.select(R.PRODUCT_KEY, "Color", "ProductCategoryName").where(F.col(R.PRODUCT_KEY).isNotNull())
    known = state.join(dim, R.PRODUCT_KEY, "left")
    revenue = merge_states(known, ["OrderYear", "Color"]).select("OrderYear", "Color", state_money("Revenue"))
    lead = merge_states(known, ["ProductCategoryName"]).select("ProductCategoryName", state_mean("AvgLeadTimeInBusinessDays"))
    return top_by_group(revenue, ["OrderYear"], "Color", "Revenue", n=1), lead
