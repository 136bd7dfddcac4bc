"""Weighted rendezvous hashing of stable record keys over shards, with gapless slots."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, partitions


def record_key(doc_id: Column, text: Column) -> Column:
    """A row's stable key: its id, or a digest of its text where it has none."""
    return F.coalesce(doc_id.cast("string"), F.concat(F.lit("text:"), F.sha2(F.coalesce(text, F.lit("")), 256)))


def shard_of(key: Column, weights: list[float]) -> Column:
    """The shard with the highest score ``-weight / ln(u)``, ``u`` uniform in (0, 1) by the key and the shard's number.

    A shard's score depends on nothing but the key and that shard, so a new
    shard takes rows only into itself, and each shard gets its weight's share.
    """
    if not weights or not all(math.isfinite(w) and w > 0 for w in weights):
        raise ValueError("weights must be positive numbers")
    scores = []
    for shard, weight in enumerate(weights):
        bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 11)  # 53 bits
        u = (bits.cast("double") + 0.5) / float(1 << 53)
        scores.append(F.struct((-weight / F.ln(u)).alias("score"), F.lit(-shard).alias("shard")))
    return -F.array_max(F.array(*scores)).getField("shard") if len(scores) > 1 else F.lit(0)


def assign_shards(docs: DataFrame, weights: list[float], grown: list[float] | None = None) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot, grown_shard`` of every row of ``docs``.

    ``grown`` are the weights after a change of the shard count. ``size`` is
    the text's UTF-8 bytes (null: none) plus 1. Slots are gapless from 0 in
    each shard: rows are dealt into hashed parts, numbered in their part, and
    the parts' counts add up, so no task orders a whole shard. A row without id
    is keyed by its text; repeated rows share a shard and take a slot each;
    other columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    parts = partitions(spark)
    text = F.coalesce("text", F.lit(""))
    key = record_key(F.col("doc_id"), F.col("text"))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.octet_length(text).cast("bigint") + 1).alias("size"),
        F.crc32(text).alias("text_crc32"),
        shard_of(key, weights).alias("shard"),
        (shard_of(key, grown) if grown else F.lit(None).cast("int")).alias("grown_shard"),
    )
    rows = rows.withColumn("part", F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(parts)).cast("int"))
    numbered = materialize(
        rows.withColumn("nth", F.row_number().over(Window.partitionBy("shard", "part").orderBy("doc_id", "text_crc32", "size"))), "shards"
    )
    # a row for each shard and part
    counts = numbered.groupBy("shard", "part").agg(F.max("nth").cast("bigint").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("part")) - F.col("n")
    starts = counts.select("shard", "part", before.alias("before"))
    return numbered.join(starts, ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("before") + F.col("nth") - 1).alias("slot"), "grown_shard"
    )


def write_shards(docs: DataFrame, weights: list[float], folder: str) -> None:
    """Write ``docs`` as Parquet under ``shard=N`` folders by the same law; all columns stay.

    Hashed parts split each shard over as many tasks as the cluster takes.
    """
    key = record_key(F.col("doc_id"), F.col("text"))
    part = F.pmod(F.xxhash64(key), F.lit(max(1, partitions(docs.sparkSession) // len(weights))))
    docs.withColumn("shard", shard_of(key, weights)).repartition("shard", part).write.partitionBy("shard").parquet(folder)
