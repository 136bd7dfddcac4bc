"""Training-corpus pipeline: quality classifier, quality rules, SimHash near-dedup, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run``
writes every stage's rows as Parquet and reads them back as the next one's
documents. All but the last return the columns of ``documents``; extra columns
pass through. Rows are judged by their own id and text: null and repeated ids,
null, empty and very long texts and empty tables are handled as the operators
define.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.llm import curve_packing, kneser_ney, quality_rules, simhash  # noqa: E402
from tidemark.llm.common import materialize, ship_package  # noqa: E402

#: Contract of the near-duplicate and packing stages.
SHINGLE_WORDS, DISTANCE, SEQUENCE_LENGTH, END_ID = 3, 3, 2048, 1


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose perplexity is over their language's threshold."""
    ship_package(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return kneser_ney.drop_rejected(docs, kneser_ney.classify(docs, labels))


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail the base rule or a rule of the cascade."""
    ship_package(spark)
    return quality_rules.passing(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each SimHash class."""
    ship_package(spark)
    return simhash.keep_one(docs, simhash.simhash_components(docs, width=SHINGLE_WORDS, distance=DISTANCE))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences: where each lies, and its token ids as little-endian unsigned 32-bit integers."""
    ship_package(spark)
    rows = curve_packing.pack(docs, length=SEQUENCE_LENGTH, end_id=END_ID)
    return rows.withColumn("ids_crc32", F.crc32("ids"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", rules),
    ("near_dedup", near_dedup),
    ("packing", packing),
]

#: No SQL: perplexities, fingerprint components and token ids are tested against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of all documents that the stages keep."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
