import pytest

from tidemark.functions.pricing import line_price_amount, line_price_rate, official_price, pct_gap
from tidemark.plans.options import PipelineOptions, PriceMode

VECTORS = [
    # qty, price, discount, spec, correct, pct
    (10, 100.0, 0.0, 1000.0, 1000.0, 0.0),
    (5, 50.0, 5.0, 225.0, -1000.0, -544.4444444444445),
    (3, 200.0, 10.0, 570.0, -5400.0, -1047.3684210526317),
    (1, 1000.0, 50.0, 950.0, -49000.0, -5257.894736842105),
    (2, 100.0, 0.1, 199.8, 180.0, -9.90990990990991),
    (2, 0.0, 0.0, 0.0, 0.0, 0.0),
    (5, 20.1865, 0.0, 100.93249999999999, 100.93249999999999, 0.0),
    (1, 10.0, None, None, None, 0.0),
]


def test_price_vectors(spark):
    df = spark.createDataFrame(VECTORS, "q int, p double, d double, spec double, corr double, pct double")
    out = df.select(
        "*",
        line_price_amount("q", "p", "d").alias("s"),
        line_price_rate("q", "p", "d").alias("c"),
    ).withColumn("g", pct_gap("s", "c"))
    for r in out.collect():
        assert r.s == (r.spec if r.spec is None else pytest.approx(r.spec, rel=1e-12))
        assert r.c == (r.corr if r.corr is None else pytest.approx(r.corr, rel=1e-12))
        assert r.g == pytest.approx(r.pct, rel=1e-9, abs=1e-12)


def test_official_price_modes(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    assert df.select(official_price("spec", "a", "b")).first()[0] == 1.0
    assert df.select(official_price(PriceMode.CORRECT, "a", "b")).first()[0] == 2.0


def test_price_mode_validated():
    with pytest.raises(ValueError):
        PipelineOptions(price_mode="rate")
    assert PipelineOptions(price_mode=" Correct ").price_mode is PriceMode.CORRECT
    with pytest.raises(TypeError):
        PipelineOptions(impute_orderdate="yes")
