"""Property tests: typing against a plain-Python model; determinism of
answers under different shuffle partitioning."""

import re

import pytest
from support import SF_SMOKE
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.functions.cleanse import tolerant_int, tolerant_long
from tidemark.plans.registry import QUERIES

_MODEL = re.compile(r"^[ \t\n\x0b\f\r]*([+-]?[0-9]+)([.][0-9]*)?[ \t\n\x0b\f\r]*$")


def _model_int(s, lo=-(2**31), hi=2**31 - 1):
    if s is None:
        return None
    m = _MODEL.match(s)
    if not m:
        return None
    v = int(m.group(1))
    return v if lo <= v <= hi else None


texts = st.one_of(
    st.none(),
    st.text(alphabet=" +-.0123456789eEx\t", max_size=14),
    st.integers(min_value=-(2**40), max_value=2**40).map(str),
)


@settings(max_examples=25, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(texts, min_size=1, max_size=40))
def test_tolerant_int_matches_model(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = df.select(tolerant_int("s").alias("i"), tolerant_long("s").alias("l")).collect()
    assert [r.i for r in got] == [_model_int(v) for v in values]
    assert [r.l for r in got] == [_model_int(v, -(2**63), 2**63 - 1) for v in values]


DETERMINISTIC = ["top_color_by_year", "formula_comparison", "dedupe_keep_populated", "avg_lead_by_category", "sample_orders"]


@pytest.mark.parametrize("name", DETERMINISTIC)
def test_same_answer_under_any_partitioning(spark, name):
    prev = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    try:
        for n in ("1", "200"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            results.append(sorted(repr(tuple(r)) for r in QUERIES[name](spark, SF_SMOKE).collect()))  # by text: NaN
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", prev)
    assert results[0] == results[1]
