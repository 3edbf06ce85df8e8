"""Queries over whole tables leave no part out."""

import pytest
from pyspark.sql import functions as F

from tallyspan.operators import grids, reshape
from tallyspan.plans import registry, sheets


def rows_of(spark, data, name):
    return registry.QUERIES[name](spark, data)


@pytest.mark.parametrize("name", ["label_match", "keyword_match"])
def test_every_item_is_matched(spark, data, name):
    got = rows_of(spark, data, name)
    assert got.count() == spark.read.parquet(f"{data}/line_item.parquet").count()
    found = got.where(got[got.columns[1]].isNotNull()).join(spark.read.parquet(f"{data}/line_item.parquet"), "item_id").select("section").distinct()
    assert {r.section for r in found.collect()} == {"ingresos", "nota_21", "nota_22", "resumen", "resultados", "indicadores"}


@pytest.mark.parametrize("name", ["sheet_items", "grid_rows", "line_values"])
def test_every_section_comes_out(spark, data, name):
    assert {"ingresos", "nota_21", "nota_22", "resumen", "resultados", "indicadores"} == {r.section for r in rows_of(spark, data, name).select("section").distinct().collect()}


def test_sections_with_one_total(spark, data):
    assert {r.section for r in rows_of(spark, data, "section_total").select("section").distinct().collect()} == {"nota_21", "nota_22", "resumen"}
    assert rows_of(spark, data, "report_rows").count() == rows_of(spark, data, "section_total").count()


def test_grid_labels_of_own_section(spark):
    rows = spark.createDataFrame([("d", "a", 1, ["Energia", "5"]), ("d", "b", 2, ["Energia", "6"]), ("d", "b", 3, ["Fletes", "7"]), ("d", "c", 4, ["Suma total", "8"])], "doc string, section string, row int, cells array<string>")
    got = grids.parse_grid(rows, ["doc", "section"], "row", "cells", {"a": ["Energia"], "b": ["Fletes"]}, section="section")
    assert sorted((r.row, r.concepto) for r in got.collect()) == [(1, "Energia"), (3, "Fletes"), (4, "Totales")]


def test_every_vector_is_combined(spark, data):
    assert rows_of(spark, data, "combined_vectors").count() == spark.read.parquet(f"{data}/embeddings.parquet").count()


def test_key_lacking_in_a_table(spark):
    make = lambda rows: spark.createDataFrame(rows, "id long, v array<float>")
    got = reshape.combine_vectors([make([(1, [3.0]), (2, [1.0])]), make([(1, [4.0]), (3, [1.0])])], "id", "v").collect()
    assert [(r.id, r.v) for r in got] == [(1, [0.6, 0.8])]


def test_every_mapped_field_comes_out(spark, data):
    mapped = {r.field for r in spark.read.parquet(f"{data}/fact_mapping.parquet").select("field").collect()}
    assert {r.field for r in rows_of(spark, data, "mapped_facts").select("field").distinct().collect()} == mapped


def test_instant_field_of_a_fourth_quarter(spark):
    facts = spark.createDataFrame([("d", 0, "Shares", "I", "50"), ("d", 1, "Sales", "AcumuladoActual", "2000")], "doc_id string, fact_ord int, name string, context_ref string, value string")
    contexts = spark.createDataFrame([("d", 0, "AcumuladoActual", "duration", None, "2024-01-01", "2024-12-31"), ("d", 1, "I", "instant", "2024-12-31", None, None)], "doc_id string, ctx_ord int, ctx_id string, period_type string, instant string, start_date string, end_date string")
    kind = "field string, primary_fact string, fallbacks array<string>, context_type string, apply_scaling boolean, ensure_negative boolean, default_value double"
    mappings = spark.createDataFrame([("acciones", "Shares", [], "instant", False, False, None), ("ventas", "Sales", [], "duration", True, False, None)], kind)
    got = sheets.from_filings(facts, contexts, mappings, F.lit(2024), F.lit(4)).collect()
    assert {(r.field, r.value) for r in got} == {("acciones", 50.0), ("ventas", 2.0)}


def test_layout_holds_every_figure(spark, data):
    values = spark.read.parquet(f"{data}/value_pdf.parquet")
    assert rows_of(spark, data, "layout_map").agg(F.sum("n")).first()[0] == values.where("value is not null").count()
