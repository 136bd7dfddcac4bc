"""CSV edges of the pipeline: all-string ingest and small sorted exports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def all_string_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def read_raw_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Read CSV with a header row, every column as text (no inference).

    With ``columns`` the schema is declared up front and no job is needed to
    read the header; a file whose header has other names or another order
    fails when it is read. Otherwise Spark takes names from the header and,
    with inference off, types every column as string. Empty fields read as NULL.
    """
    reader = spark.read.option("header", "true").option("inferSchema", "false").option("mode", "PERMISSIVE")
    if columns is not None:
        reader = reader.schema(all_string_schema(columns)).option("enforceSchema", "false")
    return reader.csv(path)


def write_single_csv(df: DataFrame, path: str, sort_by: Sequence[str] = ()) -> None:
    """Write a small result as one CSV file with a header, overwriting ``path``.

    Upstream stays parallel: the single partition is formed by a final
    ``repartition(1)`` and sorted within it. Meant for small results only
    (analysis tables, samples); large outputs belong in Parquet.
    """
    out = df.repartition(1)
    if sort_by:
        out = out.sortWithinPartitions(*sort_by)
    out.write.mode("overwrite").option("header", "true").csv(path)
