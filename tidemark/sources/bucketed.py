"""Store layers bucketed by their join key, for joins that move neither side.

The shuffle moves to the write, once; every later join or grouping on the key
reads buckets. A bucket is read by one task, which adaptive execution can't
split, so tables with a key that fills a bucket are better left unbucketed:
``largest_bucket`` tells before anything is written.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Buckets:
    """How a layer is bucketed: by ``key`` into ``count`` buckets, and the most rows a bucket may hold against the mean."""

    key: str
    count: int
    most_skew: float = 4.0

    def __post_init__(self) -> None:
        if self.count < 1:
            raise ValueError(f"a table has at least one bucket; got {self.count}")


def bucket_counts(df: DataFrame, buckets: Buckets) -> DataFrame:
    """``bucket, rows``: how many rows Spark's bucketing would send where (``hash`` is its hash function)."""
    return df.groupBy(F.pmod(F.hash(buckets.key), F.lit(buckets.count)).alias("bucket")).agg(F.count(F.lit(1)).alias("rows"))


def largest_bucket(df: DataFrame, buckets: Buckets) -> float:
    """Rows of the largest bucket as a multiple of the mean (1 where there are no rows)."""
    top = bucket_counts(df, buckets).agg(F.max("rows").alias("top"), F.sum("rows").alias("total")).first()
    return top["top"] * buckets.count / top["total"] if top["total"] else 1.0


def write_bucketed(df: DataFrame, table: str, path: str, buckets: Buckets) -> DataFrame:
    """Overwrite ``table`` (files at ``path``) with ``df``, a sorted file a bucket, and return it as it reads."""
    spark = df.sparkSession
    dealt = df.repartition(buckets.count, buckets.key)
    writer = dealt.write.mode("overwrite").format("parquet").option("path", path)
    writer.bucketBy(buckets.count, buckets.key).sortBy(buckets.key).saveAsTable(table)
    return spark.table(table)


def bucketed_pair(
    left: DataFrame, right: DataFrame, names: tuple[str, str], base: str, buckets: Buckets
) -> "tuple[DataFrame, DataFrame] | None":
    """Both sides of a join as tables with the same buckets, or None where a bucket of the left side would be too large."""
    if largest_bucket(left, buckets) > buckets.most_skew:
        return None
    return tuple(write_bucketed(df, name, f"{base.rstrip('/')}/{name}", buckets) for df, name in zip((left, right), names))


def drop_tables(spark: SparkSession, names: "tuple[str, ...]") -> None:
    """Forget tables; their files stay with whoever named the path."""
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS `{name}`")
