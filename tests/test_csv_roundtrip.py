"""The pipeline on real CSV files gives the same answers as on the raw views.

CSV cannot tell an empty field from NULL (both read back as NULL), so the
in-memory side is normalised the same way before comparing.
"""

import os

from support import SF_SMOKE
from pyspark.sql import functions as F

from tidemark.plans import retail as R
from tidemark.sources.csv import read_raw_csv
from tidemark.plans.retail import RawTables
from tidemark.sources.tpch_roles import raw_tables


def _empty_to_null(df):
    return df.select(*[F.when(F.col(c) == "", None).otherwise(F.col(c)).alias(c) for c in df.columns])


def test_pipeline_from_csv_files(spark, scratch):
    views = raw_tables(spark, SF_SMOKE)
    paths = {}
    for name in ("products", "detail", "header"):
        path = os.path.join(scratch, f"{name}.csv")
        (
            getattr(views, name)
            .write.option("header", "true")
            .option("ignoreLeadingWhiteSpace", "false")
            .option("ignoreTrailingWhiteSpace", "false")
            .csv(path)
        )
        paths[name] = path
    from_csv = RawTables(*(read_raw_csv(spark, paths[n]) for n in ("products", "detail", "header")))
    in_memory = RawTables(*(_empty_to_null(getattr(views, n)) for n in ("products", "detail", "header")))

    a, b = R.build(from_csv), R.build(in_memory)
    for attr in ("publish_product", "publish_orders", "top_color_by_year", "avg_lead_by_category"):
        # by text, as a NaN equals no other
        left = sorted(repr(tuple(r)) for r in getattr(a, attr).collect())
        right = sorted(repr(tuple(r)) for r in getattr(b, attr).collect())
        assert left == right, attr


def test_command_line_run(spark, scratch):
    from tidemark.__main__ import INPUT_FILES, main

    views = raw_tables(spark, SF_SMOKE)
    data = os.path.join(scratch, "data")
    for key, fname in INPUT_FILES.items():
        (
            getattr(views, key)
            .write.option("header", "true")
            .option("ignoreLeadingWhiteSpace", "false")
            .option("ignoreTrailingWhiteSpace", "false")
            .csv(os.path.join(data, fname))
        )
    rows = main(
        ["--data-dir", data, "--out", os.path.join(scratch, "out"), "--exports", os.path.join(scratch, "rep"),
         "--price-mode", "correct", "--impute-orderdate", "--checks"],
        spark=spark,
    )
    assert rows["publish_orders"] > 0
    assert rows["analysis_top_color_by_year"] > 0
    assert os.path.isdir(os.path.join(scratch, "rep", "analysis_avg_lead_by_category.csv"))
    quality = os.path.join(scratch, "out", "quality")
    checks = {r.check: r.violations for r in spark.read.parquet(os.path.join(quality, "order_checks")).collect()}
    assert all(v == 0 for k, v in checks.items() if k.endswith(("nonempty", "required_columns")))
    assert {"publish_product_nonempty", "analysis_top_color_by_year_nonempty", "analysis_avg_lead_by_category_nonempty"} <= set(checks)
    assert checks["lines_without_header"] > 0 and checks["negative_freight"] > 0
    edges = {r.check: r.violations for r in spark.read.parquet(os.path.join(quality, "lead_time_edges")).collect()}
    assert all(v == 0 for v in edges.values())
