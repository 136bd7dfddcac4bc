"""Data-quality checks over whole tables, one aggregation pass each.

Each check reports ``(check, violations, checked)``; a check passes when
``violations == 0``. Checks never look at a single sample row: every row of
the table is examined.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.calendar import day_number, iso_weekday
from tidemark.operators.analysis import is_ordinary


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    """Required columns the frame lacks (checked at plan time, no job)."""
    have = set(df.columns)
    return [c for c in required if c not in have]


def _rows(checks: Sequence[tuple[str, Column, Column]]) -> Column:
    return F.inline(
        F.array(
            *[
                F.struct(
                    F.lit(name).alias("check"),
                    v.cast("long").alias("violations"),
                    n.cast("long").alias("checked"),
                )
                for name, v, n in checks
            ]
        )
    )


# Internal column: number of the matched header among those of its key.
HEADER_NO = "__tidemark_header_no"


def numbered_headers(header: DataFrame, key: str) -> DataFrame:
    """Headers with their number within their key, so that a fanned-out line
    can be counted once. The window's partitioning is the join's, so it adds no
    shuffle of its own."""
    w = Window.partitionBy(key).orderBy(*[F.col(c).asc_nulls_first() for c in header.columns if c != key])
    return header.withColumn(HEADER_NO, F.row_number().over(w))


def order_checks(
    lines: DataFrame,
    *,
    qty: str = "OrderQty",
    price: str = "TotalLineExtendedPrice",
    freight: str = "TotalOrderFreight",
    order_date: str = "OrderDate",
    ship_date: str = "ShipDate",
    lead: str = "LeadTimeInBusinessDays",
    required: Sequence[str] = (),
) -> DataFrame:
    """Integrity checks of published order lines against the typed detail.

    ``lines`` are the detail lines left-joined to :func:`numbered_headers` and
    measured: published are those with a header number, and a detail line is
    counted at its first (or missing) header, so both tables are read once.

    published_nonempty, negative_freight, price_sign_mismatch (a negative price
    needs a negative quantity and vice versa), unusual_price (NaN, infinite or
    1e9 and beyond), ship_before_order, lead_time_missing, join_row_change
    (|detail rows - published rows|) and lines_without_header. With
    ``required``, a ``required_columns`` row counts the missing ones (a
    plan-time check).
    """
    no = F.col(HEADER_NO)
    pub = no.isNotNull()
    q, p = F.col(qty), F.col(price)
    sign_bad = ((p < 0) & (q >= 0)) | ((p > 0) & (q < 0))
    agg = lines.agg(
        F.count_if(pub).alias("pub_rows"),
        F.count_if(no.isNull() | (no == 1)).alias("detail_rows"),
        F.count_if(pub & (F.col(freight) < 0)).alias("neg_freight"),
        F.count_if(pub & sign_bad).alias("sign_bad"),
        F.count_if(pub & ~is_ordinary(p)).alias("unusual"),
        F.count_if(pub & (F.col(ship_date) < F.col(order_date))).alias("reversed"),
        F.count_if(pub & F.col(lead).isNull()).alias("lead_missing"),
        F.count_if(no.isNull()).alias("no_header"),
    )
    pub_rows, detail_rows = F.col("pub_rows"), F.col("detail_rows")
    return agg.select(
        _rows(
            [
                ("published_nonempty", F.when(pub_rows == 0, 1).otherwise(0), pub_rows),
                ("negative_freight", F.col("neg_freight"), pub_rows),
                ("price_sign_mismatch", F.col("sign_bad"), pub_rows),
                ("unusual_price", F.col("unusual"), pub_rows),
                ("ship_before_order", F.col("reversed"), pub_rows),
                ("lead_time_missing", F.col("lead_missing"), pub_rows),
                ("join_row_change", F.abs(detail_rows - pub_rows), detail_rows),
                ("lines_without_header", F.col("no_header"), detail_rows),
            ]
            + (
                [("required_columns", F.lit(len(missing_columns(lines, required))), F.lit(len(required)))]
                if required
                else []
            )
        )
    )


def table_checks(name: str, df: DataFrame, required: Sequence[str]) -> DataFrame:
    """``<name>_nonempty`` and ``<name>_required_columns`` of one table."""
    rows = F.col("rows")
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        _rows(
            [
                (f"{name}_nonempty", F.when(rows == 0, 1).otherwise(0), rows),
                (f"{name}_required_columns", F.lit(len(missing_columns(df, required))), F.lit(len(required))),
            ]
        )
    )


def _weekdays_in_first_days() -> list[int]:
    """Entry ``(w - 1) * 7 + r``: weekdays among the first r days (0..6) of a
    range starting on ISO weekday w (1 = Monday). Built from the rule."""
    return [sum(1 for i in range(r) if (w - 1 + i) % 7 < 5) for w in range(1, 8) for r in range(7)]


def business_days_by_weeks(start: "Column | str", end: "Column | str") -> Column:
    """Weekdays in ``[start, end)`` by a second method (full weeks plus a
    lookup for the remaining days), used to cross-check the stored lead time."""
    s = F.col(start) if isinstance(start, str) else start
    e = F.col(end) if isinstance(end, str) else end
    gap = day_number(e) - day_number(s)
    table = F.array(*[F.lit(n) for n in _weekdays_in_first_days()])
    rest = F.element_at(table, ((iso_weekday(s) - 1) * 7 + F.pmod(gap, F.lit(7)) + 1).cast("int"))
    return F.when(gap <= 0, F.lit(0)).otherwise(F.floor(gap / 7).cast("int") * 5 + rest).cast("int")


def lead_time_edges(
    published: DataFrame,
    *,
    order_date: str = "OrderDate",
    ship_date: str = "ShipDate",
    lead: str = "LeadTimeInBusinessDays",
) -> DataFrame:
    """Edge cases of the lead time, asserted on every matching row.

    mon_to_wed (expect 2), fri_to_mon (expect 1), same_day (expect 0),
    seven_day_span (any start, expect 5), reversed (ship before order, expect 0)
    and recomputed (stored lead equals :func:`business_days_by_weeks`, an
    independent method, on every row with both dates). ``checked`` is the
    number of rows in the case, ``violations`` the rows with another value.
    """
    o, s, lt = F.col(order_date), F.col(ship_date), F.col(lead)
    gap = day_number(s) - day_number(o)
    wd = iso_weekday(o)
    cases = {
        "mon_to_wed": ((wd == 1) & (gap == 2), 2),
        "fri_to_mon": ((wd == 5) & (gap == 3), 1),
        "same_day": (gap == 0, 0),
        "seven_day_span": (gap == 7, 5),
        "reversed": (gap < 0, 0),
    }
    aggs = []
    for name, (cond, expect) in cases.items():
        aggs.append(F.count_if(cond).alias(f"{name}_n"))
        aggs.append(F.count_if(cond & ~lt.eqNullSafe(F.lit(expect))).alias(f"{name}_bad"))
    both_dates = o.isNotNull() & s.isNotNull()
    aggs.append(F.count_if(both_dates).alias("recomputed_n"))
    aggs.append(F.count_if(both_dates & ~lt.eqNullSafe(business_days_by_weeks(o, s))).alias("recomputed_bad"))
    names = list(cases) + ["recomputed"]
    return published.agg(*aggs).select(
        _rows([(n, F.col(f"{n}_bad"), F.col(f"{n}_n")) for n in names])
    )
