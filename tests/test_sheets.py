"""Rule files and the sheet pipelines end to end on made documents."""

import json

import pytest
from pyspark.sql import functions as F

from tallyspan.plans import sheets
from tallyspan.sources import rules as R

RULES = {"s": {
    "_note": "comment", "fields": {"ventas": {"section": "r", "row": 1, "label": "Ventas"}, "costo": {"section": "r", "row": 2, "sign": "negative"}, "precio": {"section": "r", "row": 3, "type": "float"}, "total": {"section": "r", "row": 4, "is_total": True}},
    "sections": {"r": {"ventas": {"match": ["ventas"], "exclude": ["costo"], "labels": ["Ventas netas"]}, "costo": {"match": ["costo"], "labels": ["Costo de ventas"]}, "precio": {"match": ["precio"], "labels": ["Precio medio"]}, "total": {"match": ["suma"], "labels": ["Total"]}}},
}}


@pytest.fixture(scope="module")
def rules(spark):
    clean = R.without_comments(RULES)
    return R.keyword_table(spark, clean), R.field_table(spark, clean)


def values(df):
    return {(r.doc_id, r.field): r.value for r in df.collect()}


def test_rule_files(spark, tmp_path):
    (tmp_path / "r.json").write_text(json.dumps({"_c": 1, "a": {"_d": 2, "b": [{"_e": 1, "x": 1}]}}))
    assert R.read_rules(str(tmp_path / "r.json")) == {"a": {"b": [{"x": 1}]}}
    with pytest.raises(FileNotFoundError):
        R.read_rules(str(tmp_path / "none.json"))
    assert R.overlay({"a": {"x": 1, "y": 2}, "b": [1]}, {"a": {"y": 3}, "b": [2], "c": 4}) == {"a": {"x": 1, "y": 3}, "b": [2], "c": 4}
    with pytest.raises(ValueError, match="fields"):
        R.field_table(spark, {"s": {}})
    assert R.sum_table(spark, [{"description": "d", "total_field": "t", "sum_fields": ["a", "b"]}]).count() == 3


def test_from_lines(spark, rules):
    pages = spark.createDataFrame([("d", 2, "Ventas 9.999"), ("d", 1, "Indice de ventas\nCosto de ventas 5 MUS$ 700 1\nVentas (1.500) 3\nPrecio medio 3,57 4"), ("e", 1, None)], "doc_id string, page_no int, text string")
    assert values(sheets.from_lines(pages, *rules)) == {("d", "costo"): -700.0, ("d", "ventas"): -1500.0, ("d", "precio"): 3.57}
    assert sheets.from_lines(pages.where("false"), *rules).count() == 0


def test_from_statement(spark, rules):
    text = "Ventas 1.111\nINICIO\nVentas 2.222\nFIN\nVentas 3.333\nINICIO\nBruta\nVentas 4.444\nCosto de ventas 5.555"
    pages = spark.createDataFrame([("d", 1, text)], "doc_id string, page_no int, text string")
    got = sheets.from_statement(pages, F.col("line") == "INICIO", F.col("line") == "FIN", F.col("line") == "Bruta", *rules)
    assert values(got) == {("d", "ventas"): 4444.0, ("d", "costo"): -5555.0}


def test_from_grids(spark, rules):
    grid = [("d", 1, 0, 0, ["Ventas netas", "1"]), ("d", 1, 1, 0, ["Ventas netas\nCosto de ventas", "1.000\n(400)"]), ("d", 1, 1, 1, ["Precio medio", "-", "5"]), ("d", 1, 1, 2, ["Total", "600"]), ("d", 2, 0, 0, ["nada", "9"])]
    rows = spark.createDataFrame(grid, "doc_id string, page_no int, table_idx int, row_idx int, cells array<string>")
    assert values(sheets.from_grids(rows, *rules, section="r", least=3)) == {("d", "ventas"): 1000.0, ("d", "costo"): -400.0, ("d", "total"): 600.0}
    shifted = values(sheets.from_grids(rows, *rules, section="r", least=3, compact=True))
    assert shifted["d", "precio"] == 5.0


def test_filings_merge_checks(spark, rules):
    facts = spark.createDataFrame([("d", 0, "Sales", "AcumuladoActual", "1500000"), ("d", 1, "Cost", "AcumuladoActual", "900000")], "doc_id string, fact_ord int, name string, context_ref string, value string")
    contexts = spark.createDataFrame([("d", 0, "AcumuladoActual", "duration", None, "2024-01-01", "2024-06-30")], "doc_id string, ctx_ord int, ctx_id string, period_type string, instant string, start_date string, end_date string")
    mappings = spark.createDataFrame([("ventas", "Sales", [], "duration", True, False, None), ("costo", "Cost", [], "duration", True, True, None)], "field string, primary_fact string, fallbacks array<string>, context_type string, apply_scaling boolean, ensure_negative boolean, default_value double")
    tagged = sheets.from_filings(facts, contexts, mappings, F.lit(2024), F.lit(2))
    assert values(tagged) == {("d", "ventas"): 1500.0, ("d", "costo"): -900.0}
    text = spark.createDataFrame([("d", "ventas", 1.0), ("d", "precio", 2.5), ("e", "ventas", 7.0)], "doc_id string, field string, value double")
    assert values(sheets.combined(tagged, text, 2)) == {("d", "ventas"): 1500.0, ("d", "costo"): -900.0, ("d", "precio"): 2.5, ("e", "ventas"): 7.0}
    assert values(sheets.combined(tagged, text, 3, fill=False)) == values(text)
    assert values(sheets.combined(tagged, text, 2, fill=False)) == {("d", "ventas"): 1500.0, ("d", "costo"): -900.0, ("e", "ventas"): 7.0}
    sums = R.sum_table(spark, [{"description": "suma", "total_field": "ventas", "sum_fields": ["costo"]}])
    reference = spark.createDataFrame([("d", "ventas", 1500.0, True)], "doc_id string, field string, expected double, is_int boolean")
    got = {(r.category, r.doc_id, r.rule): r.match for r in sheets.checks(tagged, sums, reference, text).collect()}
    assert got["sum", "d", "suma"] is False and got["source", "d", "ventas"] is False and got["source", "e", "ventas"] is True and got["reference", "d", "ventas"] is True
    record = sheets.record_rows(tagged, rules[1], tagged).orderBy("row_no").collect()
    assert [(r.row_no, r.value) for r in record] == [(1, 1500.0), (2, -900.0), (3, None), (4, None)]
