"""Grouped and global measures over published order lines.

Ordinary amounts are summed as wide decimals and converted to double once: a
double sum depends on the order in which partitions are combined, the decimal
sum does not. Amounts that a decimal can't hold (NaN, infinities, very large
ones) are summed as doubles beside it, so no line ever leaves a total.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tidemark.operators.keyed import top_n_per_group

# 18 decimals hold what a double amount carries; 20 digits before them hold the
# sum of 1e11 amounts below ORDINARY.
MONEY = DecimalType(38, 18)
ORDINARY = 1e9


def _c(c: "Column | str") -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_ordinary(c: "Column | str") -> Column:
    """A finite amount below 1e9 in magnitude; NULL for NULL. NaN is not (it compares above every number)."""
    return F.abs(_c(c)) < F.lit(ORDINARY)


def money_sum(c: "Column | str") -> Column:
    """Sum of an amount column as double, every line included.

    Ordinary lines add up as ``decimal(38,18)``, exactly and in any order;
    the others (NaN, infinite, 1e9 and beyond) add up as doubles, and the two
    sums are added. So a NaN or infinite line makes its total NaN or infinite,
    as a plain double sum would, and ANSI mode makes no difference.
    """
    amount = _c(c)
    exact = F.sum(F.when(is_ordinary(amount), amount.cast(MONEY))).cast("double")
    rest = F.sum(F.when(~is_ordinary(amount), amount))
    return F.coalesce(exact + rest, exact, rest)


def money_avg(c: "Column | str") -> Column:
    """``money_sum`` over the count of non-NULL values."""
    return money_sum(c) / F.nullif(F.count(_c(c)), F.lit(0))


def no_negative_zero(c: "Column | str") -> Column:
    return _c(c) + F.lit(0.0)


def revenue_by(df: DataFrame, group: Sequence[str], amount: str, out: str = "Revenue") -> DataFrame:
    """``sum(amount)`` per group; NULL group values form their own group."""
    return df.groupBy(*group).agg(money_sum(amount).alias(out))


def top_by_group(df: DataFrame, group: Sequence[str], item: str, value: str, n: int = 1) -> DataFrame:
    """The n items with the largest value per group (NULL values last, ties by
    item ascending). A NULL group value is a group of its own."""
    return top_n_per_group(df.select(*group, item, value), group, by=value, n=n, tiebreak=[item])


def mean_by(df: DataFrame, group: Sequence[str], value: str, out: str) -> DataFrame:
    """``avg(value)`` per group; NULL values are ignored, NULL keys are a group."""
    return df.groupBy(*group).agg(F.avg(value).alias(out))


def coverage(df: DataFrame, value: str) -> DataFrame:
    """Rows where ``value`` is present, all rows, and the percentage."""
    present, total = F.count(F.col(value)), F.count(F.lit(1))
    return df.agg(
        present.alias("rows_with_value"),
        total.alias("total_rows"),
        F.when(total > 0, present * F.lit(100.0) / total).otherwise(F.lit(0.0)).alias("pct_with_value"),
    )


def duplicate_profile(df: DataFrame, key: str, dedupe_key: "str | None" = None) -> DataFrame:
    """Total rows, distinct non-NULL keys, NULL keys and rows a
    keep-one-per-key de-duplication removes. ``dedupe_key`` tells the rows of a
    NULL key apart; without it (or where it is NULL) they collapse into one.

    One pass: rows are counted per key pair before the totals."""
    extra = F.col(dedupe_key) if dedupe_key else F.lit(None).cast("string")
    groups = df.groupBy(F.col(key).alias("k"), extra.alias("d")).agg(F.count(F.lit(1)).alias("n"))
    per_key = groups.groupBy("k").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("g"))
    agg = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.count("k").alias("distinct_keys"),
        F.coalesce(F.sum(F.when(F.col("k").isNull(), F.col("n"))), F.lit(0)).alias("null_keys"),
        F.coalesce(F.sum(F.when(F.col("k").isNull(), F.col("g")).otherwise(1)), F.lit(0)).alias("kept"),
    )
    return agg.select("total_rows", "distinct_keys", "null_keys", (F.col("total_rows") - F.col("kept")).alias("duplicate_rows"))


def formula_comparison(df: DataFrame, amount: str, rate: str, gap: str) -> DataFrame:
    """One row comparing two price columns: totals, gap statistics, row count,
    and the difference of the totals in money and percent (0 if the first
    total is 0). Totals cover every line, so one NaN line makes them NaN;
    ``Ordinary_Spec`` and ``Ordinary_Correct`` are the totals of the lines whose
    two prices are ordinary, ``Unusual_Lines`` counts the others. All derived
    in Spark; nothing is collected."""
    ordinary = is_ordinary(amount) & is_ordinary(rate)
    stats = df.agg(
        money_sum(amount).alias("Total_Spec"),
        money_sum(rate).alias("Total_Correct"),
        money_avg(gap).alias("Avg_Diff_Pct"),
        no_negative_zero(F.min(gap)).alias("Min_Diff_Pct"),
        no_negative_zero(F.max(gap)).alias("Max_Diff_Pct"),
        F.count(F.lit(1)).alias("Total_Rows"),
        money_sum(F.when(ordinary, _c(amount))).alias("Ordinary_Spec"),
        money_sum(F.when(ordinary, _c(rate))).alias("Ordinary_Correct"),
        F.count_if(~ordinary).alias("Unusual_Lines"),
    )
    diff = F.col("Total_Correct") - F.col("Total_Spec")
    return stats.select(
        "*",
        diff.alias("Diff_Amount"),
        F.when(F.col("Total_Spec") != 0, diff / F.col("Total_Spec") * F.lit(100.0))
        .otherwise(F.lit(0.0))
        .alias("Diff_Pct_Total"),
    )


def row_counts(datasets: "dict[str, DataFrame]") -> DataFrame:
    """``(dataset, rows)`` for several frames in one job: a union of global
    counts, so an empty dataset still reports 0."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("dataset"), "rows")
        for name, df in datasets.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def stacked(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(dataset, rows)`` from a one-row frame with a count column per dataset."""
    return df.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("dataset"), F.coalesce(F.col(c), F.lit(0)).cast("long").alias("rows")) for c in columns]))
    )


def join_counts(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """One row: ``left_rows``, ``right_rows`` and ``joined_rows`` of the inner
    join on ``on``, without joining. Rows are counted per key (partial before
    the shuffle, so a hot key costs a row per task) and the products added up;
    each side is read once."""
    sides = left.select(F.col(on).alias("k"), F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        right.select(F.col(on).alias("k"), F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    per_key = sides.groupBy("k").agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
    return per_key.agg(
        F.sum("l").alias("left_rows"),
        F.sum("r").alias("right_rows"),
        F.sum(F.when(F.col("k").isNotNull(), F.col("l") * F.col("r"))).alias("joined_rows"),
    )
