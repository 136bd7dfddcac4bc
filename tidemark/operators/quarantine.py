"""Rejected values and malformed lines as rows, not as counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.cleanse import Role, typed
from tidemark.sources.csv import all_string_schema

#: Why a text has no typed value, by what it was to become.
REASONS: Mapping[Role, str] = {
    Role.INT: "no 32-bit integer",
    Role.LONG: "no 64-bit integer",
    Role.KEY: "no identifier",
    Role.DOUBLE: "no number",
    Role.FLAG: "neither true nor false",
    Role.TIMESTAMP: "no date",
}
CORRUPT = "_corrupt_record"


def rejected_rows(raw: DataFrame, roles: Mapping[str, "Role | str"], dataset: str, key: str) -> DataFrame:
    """``dataset, row_key, column_name, text, reason`` of every text of a typed column that does not convert.

    ``row_key`` is the row's key as it came (NULL if it has none). One scan and
    no shuffle: each row's faults are listed beside it and unfolded. The rows of
    a column are as many as ``rejected_values`` counts for it.
    """
    faults = []
    for name in raw.columns:
        role = roles.get(name)
        if role is None or Role(role) is Role.TRIM:
            continue
        bad = F.col(name).isNotNull() & typed(F.col(name), role).isNull()
        faults.append(F.when(bad, F.struct(F.lit(name).alias("column_name"), F.col(name).alias("text"), F.lit(REASONS[Role(role)]).alias("reason"))))
    row_key = F.col(key) if key in raw.columns else F.lit(None).cast("string")
    head = raw.select(F.lit(dataset).alias("dataset"), row_key.alias("row_key"), F.array_compact(F.array(*faults)).alias("faults"))
    return head.select("dataset", "row_key", F.inline("faults"))


def read_csv_with_faults(spark: SparkSession, path: "str | Sequence[str]", columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Whole rows of CSV files with a header, and their malformed lines.

    The first frame has ``columns`` as text, from lines with as many fields. The
    second has ``file, line`` for the others, as they stand in the file: nothing
    is dropped, and a line is in one of the two frames.
    """
    schema = all_string_schema(columns).add(CORRUPT, T.StringType())
    reader = spark.read.schema(schema).option("header", "true").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    reader = reader.option("columnPruning", "false")  # a line's fields are counted whatever columns a query asks for
    lines = reader.csv(path if isinstance(path, str) else list(path))
    # Spark refuses to read the column of malformed lines alone: the second condition, always true, asks for the others
    lines = lines.where((F.coalesce(*columns, F.lit("")) >= "") | F.col(CORRUPT).isNotNull())
    bad = lines.where(F.col(CORRUPT).isNotNull()).select(F.col("_metadata.file_path").alias("file"), F.coalesce(CORRUPT, columns[0]).alias("line"))
    return lines.where(F.col(CORRUPT).isNull()).select(*columns), bad
