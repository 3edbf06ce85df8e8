"""Clean-up, splits, availability, vectors, pairs and reports on small cases."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallyspan.operators import reshape


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_normalize_frame(spark):
    df = spark.createDataFrame([("2024-01-02", "1.234,5", "x", "y"), ("bad", "(2)", None, None), (None, "", "", "")], "`Fecha Año` string, `Monto (M$)` string, `a-b` string, `A.B` string")
    out = reshape.normalize_frame(df, ["Fecha Año"], ["monto_m"])
    assert out.columns == ["fecha_ano", "monto_m", "a_b", "a_b_2"]
    assert [tuple(r)[:2] for r in out.collect()] == [(datetime(2024, 1, 2), 1234.5), (None, -2.0), (None, None)]
    assert reshape.normalize_frame(df.where("false")).count() == 0 and reshape.column_name("¿?") == "column"


def test_paths_and_urls(spark):
    r = spark.range(1).select(reshape.period_paths("/d", F.lit(2024), F.lit(2)).alias("p"), reshape.data_url(F.lit("ab").cast("binary"), "image/png").alias("u"), reshape.data_url(F.lit(None).cast("binary"), "x").alias("n")).first()
    assert tuple(r.p) == ("/d/raw/2024/Q2", "/d/processed/2024_QII", "/d/output/2024", "/d/audit/2024_QII") and r.u == "data:image/png;base64,YWI=" and r.n is None


def test_availability(spark):
    keys = spark.createDataFrame([("p",), ("q",)], "k string")
    listing = spark.createDataFrame([("p", "b_estados.pdf"), ("p", "a_estados.pdf"), ("p", "estados.xml"), ("z", "x.pdf")], "k string, file string")
    got = reshape.availability(keys, listing, {"pdf": ["a_%.pdf", "%.pdf"], "xml": ["%.xml"]}, ["k"])
    assert rows(got) == [("p", "a_estados.pdf", "estados.xml"), ("q", None, None)]


def test_split_document(spark):
    pages = spark.createDataFrame([("d", 1, "a"), ("d", 2, "TITLE"), ("d", 3, None), ("e", 1, "b")], "doc string, page int, t string")
    assert rows(reshape.split_document(pages, ["doc"], "page", F.col("t").contains("TITLE")).select("doc", "page", "part")) == [("d", 1, 1), ("d", 2, 2), ("d", 3, 2), ("e", 1, 1)]


def test_vectors_pairs_reports(spark):
    a = spark.createDataFrame([(1, [3.0]), (2, [1.0])], "k int, v array<double>")
    b = spark.createDataFrame([(1, [4.0])], "k int, v array<double>")
    assert reshape.combine_vectors([a, b], "k", "v").collect()[0].v == pytest.approx([0.6, 0.8])
    pairs = spark.createDataFrame([("x_test", "y_main"), ("y_main", "x_test"), ("x_test", "z")], "a string, b string")
    assert rows(reshape.exclude_pairs(pairs, "a", "b", spark.createDataFrame([("_test", "_main")], "first string, second string"))) == [("x_test", "z")]
    checks = spark.createDataFrame([("sum", "r", 5.0, 5.0, 0.0, True), ("sum", "s", 5.0, None, None, False)], "category string, rule string, expected double, actual double, difference double, match boolean")
    assert rows(reshape.report_rows(checks, "category", "rule")) == [("sum", "mismatch: s expected 5, found -, off by -"), ("sum", "ok: r = 5")]
