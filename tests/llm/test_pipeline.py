import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.llm import curve_packing, quality_rules

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
import corpus_pipeline  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages_return_documents_and_narrow(spark, awkward):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        rows = out.collect()
        assert 0 < len(rows) <= before
        docs, before = spark.createDataFrame(rows, docs.schema), len(rows)
    ids = [r.doc_id for r in docs.select("doc_id").collect()]
    assert len(ids) == len(set(ids))


def test_run_packs_what_the_stages_keep(spark):
    rows = corpus_pipeline.run(spark, SF)
    kept = spark.read.parquet(f"{SF}/documents.parquet").join(rows.select("doc_id").distinct(), "doc_id", "left_semi")
    assert quality_rules.judge(kept).where("not kept").count() == 0
    tokens = {r.doc_id: r.n for r in curve_packing.encoded(kept, curve_packing.default_tokenizer(), 1).collect()}
    got = {r.doc_id: (r.s, r.t) for r in rows.groupBy("doc_id").agg(F.sum("length").alias("s"), F.first("doc_tokens").alias("t")).collect()}
    assert got == {k: (n, n) for k, n in tokens.items()}


def test_labelled_prose_stays(spark):
    """Of documents labelled good, the two filters keep all that pass the contract's base rule."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where("quality = 1 and toxic = 0")
    good = docs.join(labels, "doc_id", "left_semi")
    base = {r.doc_id for r in quality_rules.judge(good).where("not base_failed").collect()}
    out = docs
    for _, stage in corpus_pipeline.STAGES[:2]:
        out = stage(spark, out, "/root/testdata/sf0.01")
    kept = {r.doc_id for r in out.select("doc_id").collect()}
    assert len(base - kept) <= 0.01 * len(base)


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES], ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_awkward_and_empty_tables(spark, awkward, empty, stage):
    out = stage(spark, awkward, SF)
    assert out.count() <= awkward.count() * 400
    if stage is not corpus_pipeline.packing:
        assert out.columns == awkward.columns
    assert stage(spark, empty, SF).count() == 0
