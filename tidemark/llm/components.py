"""Connected components of an edge table, as rounds of joins over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialize


def _with_minimum(edges: DataFrame) -> DataFrame:
    """``u, v, m``: every edge with the smallest neighbour of ``u``.

    The minima are a written table, so both sides of the join are plain
    exchanges, whose large partitions adaptive execution can split; were they
    the aggregate itself, all edges of a hub would meet in one task.
    """
    return edges.join(materialize(edges.groupBy("u").agg(F.min("v").alias("m")), "minima"), "u")


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node with an edge; ``root`` is the smallest node of its component.

    ``edges`` has two bigint columns ``a`` and ``b``; null ends and loops are
    ignored, repeats and both directions are fine, an empty table gives none.
    Alternating large-star and small-star steps: every step is an aggregation
    (partial before its shuffle, so a hub costs one row a task) and a join that
    adaptive execution may split, between written tables. The edge
    table never grows and nothing but its count and checksum reaches the driver.
    """
    current = materialize(
        edges.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "edges",
    )
    before = None
    for _ in range(rounds):
        state = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = materialize(
            _with_minimum(both).where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v")), "large-stars"
        )
        small = _with_minimum(large)
        current = materialize(
            small.select("u", F.col("m").alias("v"))
            .union(small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
            .distinct(),
            "stars",
        )
    else:
        raise RuntimeError(f"components not settled after {rounds} rounds")
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        current.select("v", "v").distinct()
    )
