"""Business-day arithmetic as plain column expressions.

The lead time of an order line is the number of Monday..Friday dates ``d`` with
``start <= d < end`` (half-open). It is computed in O(1) per row from day
numbers, so it stays inside whole-stage codegen; no per-row date array is built.

Weekday counting: number the days since 1970-01-01 (a Thursday) and shift by
three so that a Monday has residue 0. ``_weekdays_before(x)`` is the number of
weekdays in ``[Monday of week 0, x)``: five per full week plus the weekdays
already passed in x's own week (at most five). The count for ``[start, end)``
is the difference of the two, clamped at 0 for same-day and reversed ranges.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed calendar constants: 1970-01-01 is a Thursday, i.e. Monday-based index 3.
EPOCH_WEEKDAY_SHIFT = 3
DAYS_PER_WEEK = 7
WORKDAYS_PER_WEEK = 5


def _as_column(c: "Column | str") -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_number(c: "Column | str") -> Column:
    """Days since 1970-01-01 of a date/timestamp column (NULL stays NULL)."""
    return F.unix_date(_as_column(c).cast("date"))


def _weekdays_before(days: Column) -> Column:
    shifted = days + F.lit(EPOCH_WEEKDAY_SHIFT)
    full_weeks = F.floor(shifted / F.lit(DAYS_PER_WEEK)).cast("long")
    into_week = F.pmod(shifted, F.lit(DAYS_PER_WEEK))
    return full_weeks * F.lit(WORKDAYS_PER_WEEK) + F.least(into_week, F.lit(WORKDAYS_PER_WEEK))


def business_days(start: "Column | str", end: "Column | str") -> Column:
    """Weekdays in ``[start, end)`` as IntegerType; NULL if either side is NULL.

    Same-day and reversed ranges are empty and give 0.
    """
    n = _weekdays_before(day_number(end)) - _weekdays_before(day_number(start))
    # Not greatest(n, 0): greatest skips NULLs and would turn a missing date into 0.
    return F.when(n < 0, F.lit(0)).otherwise(n).cast("int")


def iso_weekday(c: "Column | str") -> Column:
    """1 = Monday ... 7 = Sunday."""
    return (F.pmod(day_number(c) + F.lit(EPOCH_WEEKDAY_SHIFT), F.lit(DAYS_PER_WEEK)) + 1).cast("int")
