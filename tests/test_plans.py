"""Plan-shape checks over every registered query (no execution)."""

import pytest
from support import SF_SMOKE, plan_text

from tidemark.plans.registry import QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_is_jvm_only_and_pair_free(spark, name):
    plan = plan_text(QUERIES[name](spark, SF_SMOKE))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "CartesianProduct",
                "BroadcastNestedLoopJoin"):
        assert bad not in plan, f"{name}: {bad}"


def _read_schemas(plan):
    return [line.split("ReadSchema: ")[1] for line in plan.splitlines() if line.startswith("ReadSchema: ")]


def test_fact_scans_read_only_needed_columns(spark):
    """Products need all columns (the de-duplication tie-break orders on them),
    but the fact scans are pruned to what the answer needs."""
    schemas = _read_schemas(plan_text(QUERIES["top_color_by_year"](spark, SF_SMOKE)))
    line_scans = [s for s in schemas if "l_orderkey" in s]
    order_scans = [s for s in schemas if "o_orderkey" in s]
    assert line_scans and order_scans
    for s in line_scans:
        for col in ("l_tax", "l_returnflag", "l_linestatus", "l_suppkey"):
            assert col not in s
    for s in order_scans:
        for col in ("o_custkey", "o_totalprice", "o_orderpriority", "o_orderstatus"):
            assert col not in s


def test_top_color_uses_partial_group_limit(spark):
    plan = plan_text(QUERIES["top_color_by_year"](spark, SF_SMOKE))
    assert plan.count("WindowGroupLimit") >= 4  # partial + final, product dedupe and top-1


def test_aggregates_are_partial_before_shuffle(spark):
    plan = plan_text(QUERIES["revenue_by_year_color"](spark, SF_SMOKE))
    assert "partial_sum" in plan


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_forced_shuffle_or_broadcast(spark, name):
    df = QUERIES[name](spark, SF_SMOKE)
    assert "RoundRobinPartitioning" not in plan_text(df)
    logical = df._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in logical and "UnresolvedHint" not in logical


@pytest.mark.parametrize(
    "name, scans",
    [
        ("row_counts", {"part": 1, "lineitem": 1, "orders": 1}),
        ("dq_checks", {"part": 1, "lineitem": 1, "orders": 1}),
        ("orphan_lines", {"part": 1, "lineitem": 1, "orders": 1}),
        ("publish_orders", {"lineitem": 1, "orders": 1}),
        ("top_color_by_year", {"part": 1, "lineitem": 1, "orders": 1}),
    ],
)
def test_each_table_is_scanned_once(spark, name, scans):
    plan = plan_text(QUERIES[name](spark, SF_SMOKE), "simple")
    assert {t: plan.count(f"/{t}.parquet") for t in ("part", "lineitem", "orders")} == {"part": 0, "lineitem": 0, "orders": 0} | scans
