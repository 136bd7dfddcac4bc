import datetime as dt
import random

from pyspark.sql import functions as F

from tidemark.functions.calendar import business_days, iso_weekday

D = dt.date

# (order, ship, expected weekdays in [order, ship))
VECTORS = [
    (D(2021, 5, 31), D(2021, 6, 2), 2),  # Mon -> Wed
    (D(2021, 6, 4), D(2021, 6, 7), 1),  # Fri -> Mon
    (D(2021, 5, 31), D(2021, 6, 7), 5),  # Mon -> next Mon
    (D(2024, 1, 8), D(2024, 1, 12), 4),  # Mon -> Fri
    (D(2024, 1, 8), D(2024, 1, 15), 5),
    (D(2024, 1, 5), D(2024, 1, 8), 1),
    (D(2024, 1, 10), D(2024, 1, 10), 0),  # same day
    (D(2024, 1, 6), D(2024, 1, 7), 0),  # Sat -> Sun
    (D(2024, 1, 6), D(2024, 1, 8), 0),  # Sat -> Mon
    (D(2024, 1, 7), D(2024, 1, 9), 1),  # Sun -> Tue
    (D(2024, 1, 8), D(2024, 1, 5), 0),  # reversed
    (None, D(2024, 1, 5), None),
    (D(2024, 1, 5), None, None),
]


def _naive(a, b):
    if a is None or b is None:
        return None
    n, d = 0, a
    while d < b:
        n += d.weekday() < 5
        d += dt.timedelta(days=1)
    return n


def test_literal_vectors(spark):
    df = spark.createDataFrame(VECTORS, "o date, s date, expect int")
    rows = df.select("expect", business_days("o", "s").alias("got")).collect()
    assert [r.got for r in rows] == [r.expect for r in rows]
    assert dict(df.select(business_days("o", "s").alias("bd")).dtypes)["bd"] == "int"


def test_timestamps_use_calendar_day(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2021, 5, 31, 23, 59), dt.datetime(2021, 6, 2, 0, 1))], "o timestamp_ntz, s timestamp_ntz"
    )
    assert df.select(business_days("o", "s")).first()[0] == 2


def test_random_pairs_match_enumeration(spark):
    rng = random.Random(7)
    base = D(1961, 1, 1)
    pairs = []
    for _ in range(3000):
        a = base + dt.timedelta(days=rng.randrange(0, 33000))
        b = a + dt.timedelta(days=rng.randrange(-20, 60))
        pairs.append((a, b, _naive(a, b)))
    df = spark.createDataFrame(pairs, "o date, s date, expect int")
    bad = df.filter(~business_days("o", "s").eqNullSafe(F.col("expect"))).count()
    assert bad == 0


def test_additive_and_weekly(spark):
    rng = random.Random(11)
    rows = []
    for _ in range(500):
        a = D(2000, 1, 1) + dt.timedelta(days=rng.randrange(0, 9000))
        b = a + dt.timedelta(days=rng.randrange(0, 40))
        c = b + dt.timedelta(days=rng.randrange(0, 40))
        rows.append((a, b, c))
    df = spark.createDataFrame(rows, "a date, b date, c date")
    out = df.select(
        (business_days("a", "b") + business_days("b", "c") - business_days("a", "c")).alias("gap"),
        business_days("a", F.date_add("a", 7)).alias("week"),
    )
    assert out.filter((F.col("gap") != 0) | (F.col("week") != 5)).count() == 0


def test_iso_weekday(spark):
    df = spark.createDataFrame([(D(2024, 1, 8),), (D(2024, 1, 7),), (D(1970, 1, 1),)], "d date")
    assert [r[0] for r in df.select(iso_weekday("d")).collect()] == [1, 7, 4]


def test_second_method_agrees(spark):
    from tidemark.operators.quality import business_days_by_weeks

    rng = random.Random(3)
    rows = []
    for _ in range(2000):
        a = D(1990, 1, 1) + dt.timedelta(days=rng.randrange(0, 15000))
        rows.append((a, a + dt.timedelta(days=rng.randrange(-10, 40))))
    df = spark.createDataFrame(rows, "o date, s date")
    assert df.filter(business_days("o", "s") != business_days_by_weeks("o", "s")).count() == 0
