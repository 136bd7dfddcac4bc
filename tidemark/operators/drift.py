"""Schema contract of incoming tables, and reading layers of several schemas together."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.cleanse import Role

CONTRACT_SCHEMA = "dataset string, column_name string, position int, type string"


def contract(spark: SparkSession, dataset: str, columns: Sequence[str], roles: Mapping[str, Role]) -> DataFrame:
    """The columns a dataset is expected to have, with what each is typed to (no role: text as it stands)."""
    rows = [(dataset, c, k, (Role(roles[c]).value if c in roles else "text")) for k, c in enumerate(columns)]
    return spark.createDataFrame(rows, CONTRACT_SCHEMA)


def written_contract(df: DataFrame, dataset: str) -> DataFrame:
    """The columns and Spark types that a written layer has."""
    rows = [(dataset, name, k, kind) for k, (name, kind) in enumerate(df.dtypes)]
    return df.sparkSession.createDataFrame(rows, CONTRACT_SCHEMA)


def schema_changes(expected: DataFrame, incoming: DataFrame) -> DataFrame:
    """``dataset, column_name, change, expected, incoming``: a row for every column that is added, missing, retyped or moved.

    Names are compared exactly; a column that is there under another case is
    ``renamed``. Columns that agree give no row.
    """
    keys = ["dataset", "column_name"]
    a = expected.select(*keys, F.col("type").alias("old_type"), F.col("position").alias("old_position"))
    b = incoming.select(*keys, F.col("type").alias("new_type"), F.col("position").alias("new_position"))
    both = a.join(b, keys, "full")
    low = F.lower("column_name")
    missing = both.where("new_type is null").select("dataset", low.alias("low"), F.col("column_name").alias("old_name"))
    added = both.where("old_type is null").select("dataset", low.alias("low"), F.col("column_name").alias("new_name"))
    renamed = missing.join(added, ["dataset", "low"]).select("dataset", "old_name", "new_name")
    change = (
        F.when(F.col("old_type").isNull(), "added")
        .when(F.col("new_type").isNull(), "missing")
        .when(F.col("old_type") != F.col("new_type"), "retyped")
        .when(F.col("old_position") != F.col("new_position"), "moved")
    )
    value = lambda kind, position: F.when(change == "moved", F.col(position).cast("string")).otherwise(F.col(kind))
    rows = both.select(*keys, change.alias("change"), value("old_type", "old_position").alias("expected"), value("new_type", "new_position").alias("incoming")).where("change is not null")
    gone = renamed.select("dataset", F.explode(F.array("old_name", "new_name")).alias("column_name"))
    rest = rows.join(gone, keys, "left_anti")
    return rest.unionByName(
        renamed.select("dataset", F.col("old_name").alias("column_name"), F.lit("renamed").alias("change"), F.col("old_name").alias("expected"), F.col("new_name").alias("incoming"))
    )


def read_together(spark: SparkSession, paths: Sequence[str], types: "Mapping[str, str] | None" = None) -> DataFrame:
    """Parquet layers of several schemas as one frame: every column of any of them, by name.

    A column that a layer lacks is NULL there. One that layers have in different
    types takes the type that ``types`` names, or else the widest in which Spark
    can unite them; text stands for all where nothing else does. No row is lost.
    """
    frames = [spark.read.parquet(p) for p in paths]
    kinds: dict[str, list[str]] = {}
    for f in frames:
        for name, kind in f.dtypes:
            kinds.setdefault(name, []).append(kind)
    order = ["tinyint", "smallint", "int", "bigint", "float", "double"]
    target = {}
    for name, found in kinds.items():
        if types and name in types:
            target[name] = types[name]
        elif len(set(found)) == 1:
            target[name] = found[0]
        elif set(found) <= set(order):
            widest = max(found, key=order.index)
            target[name] = "double" if widest in ("float", "double") else widest
        else:
            target[name] = "string"
    out = None
    for f in frames:
        have = set(f.columns)
        one = f.select(*[(F.col(f"`{n}`").try_cast(k) if n in have else F.lit(None).cast(k)).alias(n) for n, k in target.items()])
        out = one if out is None else out.unionByName(one)
    if out is None:
        raise ValueError("no paths")
    return out
