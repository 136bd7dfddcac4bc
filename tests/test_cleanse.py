import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions.cleanse import (
    is_incomplete_date,
    parse_timestamp,
    repaired_timestamp,
    strict_flag,
    tolerant_double,
    tolerant_int,
    tolerant_key,
    tolerant_long,
    trimmed,
)
from tidemark.operators.typing import apply_roles, rejected_values


def _one(spark, values, expr, schema="s string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(expr(F.col("s"))).collect()]


def test_flags(spark):
    vals = ["TRUE", "false", "True", "FALSE", "1", "t", " true", None, "yes"]
    assert _one(spark, vals, strict_flag) == [True, False, True, False, None, None, None, None, None]


def test_tolerant_int(spark):
    vals = ["12", "12.5", "-3.9", " 12 ", "01", "+7", "12.", "x", "", "1e3", "99999999999", "0x1F", None, "\t4"]
    assert _one(spark, vals, tolerant_int) == [12, 12, -3, 12, 1, 7, 12, None, None, None, None, None, None, 4]


def test_tolerant_long_keeps_large_ids(spark):
    assert _one(spark, ["99999999999", " 5000000000 "], tolerant_long) == [99999999999, 5000000000]


def test_tolerant_double(spark):
    assert _one(spark, ["1.5", " 2 ", "37e-1", "n/a", "", None], tolerant_double) == [1.5, 2.0, 3.7, None, None, None]


def test_trim_spaces_only(spark):
    assert _one(spark, ["  Red ", "   ", "\tX\t", None], trimmed) == ["Red", "", "\tX\t", None]


def test_timestamps(spark):
    vals = ["2021-06-01 10:00:00", "2021-06-01", "2021-6", "garbage", None]
    # '2021-6' is not 7 characters, so it is not "incomplete": it parses as 1 June
    assert _one(spark, vals, parse_timestamp) == [
        dt.datetime(2021, 6, 1, 10), dt.datetime(2021, 6, 1), dt.datetime(2021, 6, 1), None, None
    ]


def test_incomplete_dates_and_repair(spark):
    rows = [
        ("2021-06", "2021-06-10 00:00:00"),
        ("garbage", "2021-06-10 00:00:00"),  # 7 characters: incomplete too
        ("2021-06", None),
        ("2021-05-31 00:00:00", "2021-06-07 00:00:00"),
    ]
    df = spark.createDataFrame(rows, "o string, s string")
    got = df.select(
        is_incomplete_date("o").alias("inc"),
        repaired_timestamp("o", "s", impute=False).alias("null_fix"),
        repaired_timestamp("o", "s", impute=True).alias("impute_fix"),
    ).collect()
    assert [r.inc for r in got] == [True, True, True, False]
    assert [r.null_fix for r in got] == [None, None, None, dt.datetime(2021, 5, 31)]
    assert [r.impute_fix for r in got] == [dt.datetime(2021, 6, 3), dt.datetime(2021, 6, 3), None, dt.datetime(2021, 5, 31)]


def test_apply_roles_presence_guarded(spark):
    df = spark.createDataFrame([(" 1 ", "x", "keep")], "id string, n string, other string")
    out = apply_roles(df, {"id": "long", "n": "int", "missing": "double"})
    assert out.columns == ["id", "n", "other"]
    assert out.first() == (1, None, "keep")
    assert dict(out.dtypes) == {"id": "bigint", "n": "int", "other": "string"}


def test_rejected_values(spark):
    df = spark.createDataFrame([("1", "x"), ("x", None), (None, "2.5")], "a string, b string")
    r = rejected_values(df, {"a": "int", "b": "double"}).first()
    assert (r.rows, r.a_rejected, r.b_rejected) == (3, 1, 1)


def test_zoned_timestamps_are_moved_to_utc(spark):
    cases = {
        "2021-06-01T23:00:00-05:00": "2021-06-02 04:00:00",
        "2021-06-01 23:00:00+02:30": "2021-06-01 20:30:00",
        "2021-06-01T23:00:00Z": "2021-06-01 23:00:00",
        "2021-06-01 23:00:00": "2021-06-01 23:00:00",
        "2021-06-01": "2021-06-01 00:00:00",
        "2021-06-01T23:00:00.25-00:30": "2021-06-01 23:30:00.25",
        "1950-01-01T00:00:00+01:00": "1949-12-31 23:00:00",
        "soon": None,
        None: None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string").select("t", parse_timestamp("t").cast("string").alias("u"))
    for zone in ("UTC", "America/Sao_Paulo"):
        prev = spark.conf.get("spark.sql.session.timeZone")
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            assert {r.t: r.u for r in df.collect()} == cases
        finally:
            spark.conf.set("spark.sql.session.timeZone", prev)


def test_identifiers_reject_fractions(spark):
    cases = {"12": 12, " 12 ": 12, "012": 12, "12.0": 12, "12.": 12, "12.5": None, "x": None, "99999999999999999999": None, "-3": -3, "": None, None: None}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    assert {r.t: r.k for r in df.select("t", tolerant_key("t").alias("k")).collect()} == cases
