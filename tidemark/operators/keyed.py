"""Keep the first n rows per key under a total order.

``row_number() <= n`` over a key window is planned by Spark as a partial
``WindowGroupLimit`` before the shuffle and a final one after it, so a hot key
sends at most n rows per map task across the network, never the whole group.
Spark plans that limit up to n = 1000 only. For larger n the rows of a key are
first ranked within random-like parts of it (a hash of the row), n rows of each
part stay, and only those meet in the final ranking.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__tidemark_rank"
_PART = "__tidemark_part"
# Largest n for which Spark plans a partial window limit (its default threshold).
PLANNED_LIMIT = 1000


def _orderable(df: DataFrame, name: str) -> bool:
    t = df.schema[name].dataType.typeName()
    return t not in ("map", "variant")


def first_n_by(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    n: int = 1,
    tiebreak_rest: bool = True,
) -> DataFrame:
    """Rows ranked 1..n within each key by ``order``.

    With ``tiebreak_rest`` the remaining columns (ascending, NULLs first) break
    ties, so the result is deterministic: rows that still tie are identical.
    """
    if n < 1:
        raise ValueError("n must be >= 1")
    full = list(order)
    if tiebreak_rest:
        used = set(keys)
        full += [F.col(c).asc_nulls_first() for c in df.columns if c not in used and _orderable(df, c)]
    by = [F.col(k) for k in keys]

    def ranked(rows: DataFrame, *parts: Column) -> DataFrame:
        w = Window.partitionBy(*by, *parts).orderBy(*full)
        return rows.withColumn(_RANK, F.row_number().over(w)).filter(F.col(_RANK) <= F.lit(n)).drop(_RANK)

    if n > PLANNED_LIMIT:
        hashed = [F.col(c) for c in df.columns if _orderable(df, c)]
        parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        df = ranked(df.withColumn(_PART, F.pmod(F.xxhash64(*hashed), F.lit(parts))), F.col(_PART)).drop(_PART)
    return ranked(df)


def keep_first_by_preference(df: DataFrame, keys: Sequence[str], prefer: Sequence[Column]) -> DataFrame:
    """One row per key: the most preferred (``prefer`` ascending) row."""
    return first_n_by(df, keys, prefer, n=1)


def top_n_per_group(
    df: DataFrame,
    group: Sequence[str],
    by: str,
    n: int = 1,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Rows with the n largest ``by`` per group (NULLs last), ties broken by
    ``tiebreak`` ascending and then by the remaining columns."""
    order = [F.col(by).desc_nulls_last()] + [F.col(c).asc_nulls_first() for c in tiebreak]
    return first_n_by(df, group, order, n=n)
