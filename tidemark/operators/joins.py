"""Joins of order lines to headers and dimensions.

No join carries a hint: Spark broadcasts a side whose measured size is under
its threshold, else it is a sort-merge join whose skewed partitions adaptive
execution splits (``spark.sql.adaptive.skewJoin.enabled``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Prefix of a header column whose name the detail has too.
HEADER_PREFIX = "Header_"


def _keys(on: "str | Sequence[str]") -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def header_columns(detail: DataFrame, header: DataFrame, on: "str | Sequence[str]") -> dict[str, str]:
    """Output name of every non-key header column: its own, or with
    ``Header_`` in front (again, if need be) where the detail has that name."""
    keys = _keys(on)
    taken = set(detail.columns)
    out: dict[str, str] = {}
    for c in header.columns:
        if c in keys:
            continue
        name = c
        while name in taken:
            name = HEADER_PREFIX + name
        taken.add(name)
        out[c] = name
    return out


def lines_with_header(detail: DataFrame, header: DataFrame, on: "str | Sequence[str]", how: str = "inner") -> DataFrame:
    """Inner equi-join (or ``how``) keeping one copy of the key (USING semantics).

    Lines with a NULL or unmatched key drop out; duplicate headers fan out.
    Output: key, detail columns, header columns. A column of both sides keeps
    the detail's value under its name and the header's under ``Header_<name>``.
    """
    keys = _keys(on)
    names = header_columns(detail, header, keys)
    return detail.join(header.select(*keys, *[F.col(c).alias(n) for c, n in names.items()]), on=keys, how=how)


def join_dimension(fact: DataFrame, dim: DataFrame, on: "str | Sequence[str]", how: str = "left") -> DataFrame:
    """Equi-join a fact table to a dimension (USING semantics).

    With ``how='left'`` unmatched facts keep NULL dimension attributes.
    """
    return fact.join(dim, on=_keys(on), how=how)


def orphans(fact: DataFrame, dim: DataFrame, on: "str | Sequence[str]") -> DataFrame:
    """Fact rows whose key has no match in ``dim`` (left anti join).

    Rows with a NULL key are orphans as well (NULL never matches).
    """
    keys = _keys(on)
    return fact.join(dim.select(*keys), on=keys, how="left_anti")


def orphan_counts(fact: DataFrame, dims: "dict[str, tuple[DataFrame, str]]") -> DataFrame:
    """One row with, for each ``name -> (dim, key)``, the fact rows whose key
    has no match (NULL keys included). The fact table is read once: distinct
    keys of every dimension are left-joined one after another."""
    out = fact.select(*dict.fromkeys(key for _, key in dims.values()))
    for name, (dim, key) in dims.items():
        known = dim.select(F.col(key).alias(f"__{name}")).where(F.col(f"__{name}").isNotNull()).distinct()
        out = out.join(known, out[key] == known[f"__{name}"], "left")
    return out.agg(*[F.count_if(F.col(f"__{name}").isNull()).alias(name) for name in dims])
