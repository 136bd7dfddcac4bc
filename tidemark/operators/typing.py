"""Type a raw all-string table from a role map, in one projection."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.cleanse import Role, typed


def apply_roles(
    df: DataFrame,
    roles: Mapping[str, "Role | str"],
    overrides: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Retype columns by role, keeping column order; one ``select``.

    Presence-guarded: roles for columns the table lacks are ignored, and
    columns without a role pass through unchanged. ``overrides`` replaces the
    expression of a present column (e.g. a repaired date).
    """
    overrides = dict(overrides or {})
    cols = []
    for name in df.columns:
        if name in overrides:
            expr = overrides[name]
        elif name in roles:
            expr = typed(F.col(name), roles[name])
        else:
            expr = F.col(name)
        cols.append(expr.alias(name))
    return df.select(*cols)


def rejected_values(raw: DataFrame, roles: Mapping[str, "Role | str"]) -> DataFrame:
    """One row: for every typed (non-trim) column present in ``raw``, the
    number of non-NULL texts that did not convert (``<column>_rejected``),
    plus ``rows``. One aggregation pass over the raw table."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    for name in raw.columns:
        role = roles.get(name)
        if role is None or Role(role) is Role.TRIM:
            continue
        bad = F.col(name).isNotNull() & typed(F.col(name), role).isNull()
        aggs.append(F.count_if(bad).alias(f"{name}_rejected"))
    return raw.agg(*aggs)
