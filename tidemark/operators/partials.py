"""Mergeable partial states of the grouped answers.

A state holds what a group's lines add up to, so states of different lines
merge by adding: ordinary amounts as an exact decimal, the others (NaN,
infinite, very large) as a double, and counts. States are kept by year and
product, not by colour and category: a product that changes its colour later
needs no line to be read again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.analysis import MONEY, is_ordinary

#: Columns of a state behind its group columns.
STATE_COLUMNS = ("money_exact", "money_rest", "measure_sum", "measure_count", "line_count")


def partial_state(lines: DataFrame, group: Sequence[str], amount: str, measure: str) -> DataFrame:
    """State of ``amount`` (money) and ``measure`` (an integer to be averaged) by ``group``; NULL group values are groups."""
    money = F.col(amount)
    return lines.groupBy(*group).agg(
        F.sum(F.when(is_ordinary(money), money.cast(MONEY))).alias("money_exact"),
        F.sum(F.when(~is_ordinary(money), money)).alias("money_rest"),
        F.sum(F.col(measure).cast("bigint")).alias("measure_sum"),
        F.count(measure).alias("measure_count"),
        F.count(F.lit(1)).alias("line_count"),
    )


def merge_states(states: DataFrame, group: Sequence[str]) -> DataFrame:
    """One state a group: sums of the parts. ``group`` may be coarser than what the states were made by."""
    return states.groupBy(*group).agg(*[F.sum(c).alias(c) for c in STATE_COLUMNS])


def state_money(out: str) -> Column:
    """The amount that a state stands for, as ``analysis.money_sum`` gives it over the lines."""
    exact, rest = F.col("money_exact").cast("double"), F.col("money_rest")
    return F.coalesce(exact + rest, exact, rest).alias(out)


def state_mean(out: str) -> Column:
    """The mean that a state stands for; NULL where no line has a value."""
    return (F.col("measure_sum").cast("double") / F.nullif(F.col("measure_count"), F.lit(0))).alias(out)
