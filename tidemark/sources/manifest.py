"""A manifest of input files and of the steps that were written from them.

Two small Parquet tables in the quality layer, appended to by one writer:

* ``manifest_files``: which version of which input file a batch took in, and
  which versions it retired. A version is a hash of dataset, path, length and
  modification time, so a changed file is a new version of its path.
* ``manifest_steps``: a row for every step of a batch that was written whole.

A batch is planned before its first step and finished by its last. A run that
ends between leaves a planned batch whose remaining steps the next run writes.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.layers import Layout

FILE_SCHEMA = "batch int, dataset string, file string, length bigint, modified timestamp, version bigint, state string"
STEP_SCHEMA = "batch int, step string, rows bigint, options string"
CURRENT, GONE = "current", "gone"


def file_version(dataset: str) -> Column:
    """Version of the file that a row was read from, by the scan's metadata column."""
    m = F.col("_metadata")
    return F.xxhash64(F.lit(dataset), m["file_path"], m["file_size"], m["file_modification_time"])


def list_files(spark: SparkSession, dataset: str, path: str) -> DataFrame:
    """``dataset, file, length, modified, version`` of the files under ``path``; their contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    m = F.col("_metadata")
    return files.select(
        F.lit(dataset).alias("dataset"),
        m["file_path"].alias("file"),
        m["file_size"].alias("length"),
        m["file_modification_time"].alias("modified"),
        file_version(dataset).alias("version"),
    )


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The Parquet table at ``path``, or an empty one where nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in (e.getCondition() or ""):
            raise
        return spark.createDataFrame([], schema)


class Manifest:
    """What was taken in and written under one layout. One writer at a time."""

    def __init__(self, spark: SparkSession, layout: Layout) -> None:
        self.spark = spark
        self.files_path = layout.path("quality", "manifest_files")
        self.steps_path = layout.path("quality", "manifest_steps")
        self._summary: "set[tuple[int, str, str]] | None" = None
        self._steps: "dict[tuple[int, str], tuple[int, str]] | None" = None

    def files(self) -> DataFrame:
        return read_or_empty(self.spark, self.files_path, FILE_SCHEMA)

    def steps(self) -> DataFrame:
        return read_or_empty(self.spark, self.steps_path, STEP_SCHEMA)

    def current(self) -> DataFrame:
        """Versions that were taken in and not retired since."""
        files = self.files()
        return files.where(F.col("state") == CURRENT).join(files.where(F.col("state") == GONE).select("version"), "version", "left_anti")

    def retired(self, upto: int) -> DataFrame:
        """``version`` of the file versions that a batch up to ``upto`` retired."""
        return self.files().where((F.col("state") == GONE) & (F.col("batch") <= upto)).select("version").distinct()

    def refresh(self) -> None:
        """Forget what was read: another run may have written since."""
        self._summary = self._steps = None

    def _known(self) -> set[tuple[int, str, str]]:
        """``batch, dataset, state`` of the planned files (a row each reaches the driver)."""
        if self._summary is None:
            self._summary = {tuple(r) for r in self.files().select("batch", "dataset", "state").distinct().collect()}
        return self._summary

    def _written(self) -> dict[tuple[int, str], tuple[int, str]]:
        """``(batch, step) -> (rows, options)`` of the committed steps (a row a step reaches the driver)."""
        if self._steps is None:
            self._steps = {(r["batch"], r["step"]): (r["rows"], r["options"]) for r in self.steps().collect()}
        return self._steps

    def retiring(self, upto: int) -> list[int]:
        """Batches up to ``upto`` that retire versions."""
        return sorted({batch for batch, _, state in self._known() if state == GONE and batch <= upto})

    def touched(self, batch: int, dataset: str, state: "str | None" = None) -> bool:
        """Whether a batch takes in or retires files of a dataset (or the one that ``state`` says)."""
        return any(b == batch and d == dataset and state in (None, s) for b, d, s in self._known())

    def last_planned(self) -> int:
        return max((b for b, *_ in self._known()), default=0)

    def committed(self, batch: int) -> dict[str, int]:
        """Steps of a batch that were written whole, with their rows."""
        return {step: rows for (b, step), (rows, _) in self._written().items() if b == batch}

    def batches(self, step: str) -> dict[int, int]:
        """Batches that committed a step, with its rows."""
        return {b: rows for (b, s), (rows, _) in sorted(self._written().items()) if s == step}

    def options(self) -> set[str]:
        """Options that the committed steps were written with."""
        return {options for _, options in self._written().values()}

    def changes(self, inputs: Mapping[str, str]) -> DataFrame:
        """Files under ``inputs`` (dataset -> path) that no batch has taken in yet, and versions that are no longer there."""
        listed = None
        for dataset, path in inputs.items():
            rows = list_files(self.spark, dataset, path)
            listed = rows if listed is None else listed.unionByName(rows)
        known = self.current()
        columns = ["dataset", "file", "length", "modified", "version"]
        new = listed.join(known.select("version"), "version", "left_anti").select(*columns, F.lit(CURRENT).alias("state"))
        lost = known.join(listed.select("version"), "version", "left_anti").select(*columns, F.lit(GONE).alias("state"))
        return new.unionByName(lost)

    def plan(self, batch: int, changes: DataFrame) -> int:
        """Write the batch's files; returns how many rows there are (0: nothing changed, nothing written)."""
        rows = changes.select(F.lit(batch).alias("batch"), *[c.split()[0] for c in FILE_SCHEMA.split(", ")[1:]]).cache()
        try:
            count = rows.count()
            if count:
                rows.coalesce(1).write.mode("append").parquet(self.files_path)
                self._summary = None
            return count
        finally:
            rows.unpersist()

    def commit(self, batch: int, step: str, rows: int, options: str) -> None:
        self.spark.createDataFrame([(batch, step, rows, options)], STEP_SCHEMA).coalesce(1).write.mode("append").parquet(self.steps_path)
        self._written()[batch, step] = (rows, options)

    def new_files(self, batch: int, dataset: str) -> list[str]:
        """Paths that a batch takes in for one dataset (a row a file reaches the driver: paths are what a reader is given)."""
        mine = self.files().where((F.col("batch") == batch) & (F.col("dataset") == dataset) & (F.col("state") == CURRENT))
        return [r["file"] for r in mine.select("file").distinct().orderBy("file").collect()]
