"""XML filings, contexts, mapped values, pages, links, sinks and streams on files made here."""

import io
import json
from datetime import datetime
import zipfile

from pyspark.sql import functions as F

from tallyspan.operators import filings
from tallyspan.sinks import files as sinks
from tallyspan.sources import filings as sources
from tallyspan.streaming import ingest

XML = """<?xml version="1.0" encoding="UTF-8"?>
<xbrl xmlns="http://www.xbrl.org/2003/instance" xmlns:t="urn:t">
  <context id="AcumuladoActual"><entity><identifier scheme="urn:r">EM-1</identifier></entity><period><startDate>2024-01-01</startDate><endDate>2024-06-30</endDate></period></context>
  <context id="Cierre"><entity><identifier scheme="urn:r">EM-1</identifier></entity><period><instant>2024-06-30</instant></period></context>
  <t:Revenue contextRef="AcumuladoActual" unitRef="USD" decimals="-3">1500999</t:Revenue>
  <t:CostOfSales contextRef="AcumuladoActual" unitRef="USD">-700000</t:CostOfSales>
  <t:Note contextRef="Cierre">texto ó</t:Note>
</xbrl>"""


def _folder(tmp_path):
    (tmp_path / "a_2024Q2.xml").write_text(XML, encoding="utf-8")
    (tmp_path / "latin.xml").write_bytes(XML.encode("iso-8859-1"))
    (tmp_path / "broken.xml").write_text("<a><b></a>")
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("readme.txt", "x")
        z.writestr("f.xbrl", XML)
    b = io.BytesIO()
    zipfile.ZipFile(b, "w").close()
    (tmp_path / "none.zip").write_bytes(b.getvalue())
    (tmp_path / "empty.xml").write_bytes(b"")
    return str(tmp_path)


def test_read_filings(spark, tmp_path):
    path = _folder(tmp_path)
    facts = sources.read_facts(spark, path)
    got = {(r.doc_id, r.fact_ord): (r.name, r.namespace, r.value, r.context_ref, r.unit_ref, r.decimals) for r in facts.collect()}
    assert got["a_2024Q2", 0] == ("Revenue", "urn:t", "1500999", "AcumuladoActual", "USD", "-3")
    assert got["latin", 2][2] == "texto ó" and got["z", 1][0] == "CostOfSales" and len(got) == 9
    contexts = {(r.doc_id, r.ctx_ord): tuple(r)[2:] for r in sources.read_contexts(spark, path, "a*").collect()}
    assert contexts == {("a_2024Q2", 0): ("AcumuladoActual", "duration", None, "2024-01-01", "2024-06-30", "EM-1", "urn:r"), ("a_2024Q2", 1): ("Cierre", "instant", "2024-06-30", None, None, "EM-1", "urn:r")}
    assert {r.doc_id for r in sources.read_errors(spark, path).collect()} == {"broken", "none"}


def test_xpath(spark):
    df = spark.createDataFrame([(1, "<a><b>x</b><b>y</b></a>", "<a xmlns:p='urn:p'><p:b>z</p:b></a>"), (2, None, None)], "i int, u string, v string")
    assert df.orderBy("i").select(sources.xpath_texts(F.col("u"), "a/b/text()").alias("t")).collect()[0].t == ["x", "y"]
    got = {r.i: r["values"] for r in sources.xpath_prefixed(df, ["i"], "v", "p:b", {"p": "urn:p"}).collect()}
    assert got[1] == ["z"] and got[2] is None


def _contexts(spark, rows):
    return spark.createDataFrame(rows, "doc_id string, ctx_ord int, ctx_id string, period_type string, instant string, start_date string, end_date string, entity_id string")


def test_contexts(spark):
    c = _contexts(spark, [
        ("a", 0, "D1", "duration", None, "2024-01-01", "2024-06-30", None), ("a", 1, "TrimestreAcumuladoActual", "duration", None, "2024-04-01", "2024-06-30", None),
        ("b", 0, "X", "duration", None, "2023-01-01", "2023-12-31", None), ("b", 1, "Y", "duration", None, "2024-01-01", "2024-06-30", None), ("b", 2, "Z", "duration", None, "2024-01-01", "2024-06-30", None),
        ("c", 0, "P", "duration", None, "2022-01-01", "2022-12-31", None), ("c", 1, "Q", "duration", None, "2023-01-01", "2023-03-31", None), ("c", 2, "R", "duration", None, None, None, None),
        ("d", 0, "I", "instant", "2024-06-30", None, None, None),
    ])
    got = {r.doc_id: (r.ctx_id, r.strategy) for r in filings.chosen_context(c, F.lit(2024), F.lit(2)).collect()}
    assert got == {"a": ("TrimestreAcumuladoActual", 1), "b": ("Y", 2), "c": ("Q", 3)}
    assert {r.doc_id: r.ctx_id for r in filings.latest_context(c).collect()} == {"a": "D1", "b": "Y", "c": "Q"}
    assert {r.doc_id: r.ctx_id for r in filings.chosen_context(c, F.lit(2024), F.lit(2), yearly=True).collect()} == {"d": "I"}


def test_mapped_values(spark):
    facts = spark.createDataFrame(
        [("a", 0, "Sales", "C", "x"), ("a", 1, "Ventas", "C", "-1999"), ("a", 2, "Ventas", "C", "5000"), ("a", 3, "Cost", "C", "7000"), ("a", 4, "Cost", "Other", "1"), ("b", 0, "Cost", "C", " 8 \n")], "doc_id string, fact_ord int, name string, context_ref string, value string"
    )
    mappings = spark.createDataFrame(
        [("s", "Sales", ["Ventas"], "duration", True, False, None), ("c", "Cost", None, "duration", False, True, None), ("o", "Other", [], "duration", True, False, 0.0)],
        "field string, primary_fact string, fallbacks array<string>, context_type string, apply_scaling boolean, ensure_negative boolean, default_value double",
    )
    chosen = spark.createDataFrame([("a", "C"), ("b", "C")], "doc_id string, ctx_id string")
    got = {(r.doc_id, r.field): (r.value, r.fact) for r in filings.mapped_values(facts, mappings, chosen).collect()}
    assert got == {("a", "s"): (-1.0, "Ventas"), ("a", "c"): (-7000.0, "Cost"), ("b", "c"): (-8.0, "Cost"), ("a", "o"): (0.0, None), ("b", "o"): (0.0, None)}
    assert filings.mapped_values(facts, mappings, chosen, floor=True).where("field = 's'").first().value == -2.0


def test_pages_links_ocr(spark, tmp_path):
    (tmp_path / "d.txt").write_text("uno\fdos")
    assert [(r.page_no, r.text) for r in sources.read_pages(spark, str(tmp_path)).orderBy("page_no").collect()] == [(1, "uno"), (2, "dos")]
    html = "<a href='/x/31-03-2024.pdf'>t</a> <a class=b href=\"y\">al 2023-12-31</a><a href='z'>31-05-2024</a><a href='w'>none</a>"
    df = spark.createDataFrame([(html,), (None,), ("",)], "h string")
    assert [[tuple(x) for x in r.p or []] for r in df.select(sources.link_periods(F.col("h")).alias("p")).collect()] == [[("/x/31-03-2024.pdf", 2024, 1), ("y", 2023, 4)], [], []]
    images = spark.createDataFrame([("d", 1, bytearray(b"ok")), ("d", 2, bytearray(b"bad"))], "doc_id string, page_no int, content binary")

    def first(data):
        if data == b"bad":
            raise ValueError("unreadable")
        return data.decode()

    got = {r.page_no: (r.text, r.error) for r in sources.ocr_pages(images, first).collect()}
    assert got == {1: ("ok", None), 2: (None, "unreadable")}
    assert sources.ocr_pages(images, first, [lambda data: "second"]).where("page_no = 2").first().text == "second"


def test_files_by_pattern(spark):
    listing = spark.createDataFrame([("p", "b.pdf"), ("p", "c.pdf"), ("q", "x")], "key string, file string")
    patterns = spark.createDataFrame([("p", "a.pdf", 0), ("p", "b.pdf", 1), ("p", "c.pdf", 2)], "key string, file string, rank int")
    assert [tuple(r) for r in sources.first_existing(listing, patterns).collect()] == [("p", "b.pdf", 1)]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(2024, 1, "s", 5, None), (2024, 2, "s", None, "é")], "year int, quarter int, sheet string, x int, t string")
    sinks.write_records(df, str(tmp_path / "j"))
    sinks.write_records(df.where("quarter = 2").withColumn("x", F.lit(9)), str(tmp_path / "j"))
    assert {(r.quarter, r.x) for r in spark.read.json(str(tmp_path / "j")).collect()} == {(1, 5), (2, 9)}
    sinks.write_csv(df, str(tmp_path / "c"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).count() == 2
    wrapped = {r.file_name: json.loads(r.content) for r in sinks.wrapped_records(df, "sheet", "year", "quarter", ["x", "t"]).collect()}
    assert wrapped["s_2024_QII.json"] == {"sheet_name": "s", "year": 2024, "quarter": 2, "period": "2024_QII", "content": {"x": None, "t": "é"}}
    sinks.write_workbook({"first " * 9: df, "b": df.where("false")}, str(tmp_path / "w.xlsx"))
    with zipfile.ZipFile(tmp_path / "w.xlsx") as z:
        assert z.read("xl/worksheets/sheet1.xml").count(b"<row") == 3 and len(z.namelist()) == 6
    sinks.write_workbook({"a": df, "A": df, "x" * 40: df, "x" * 35: df}, str(tmp_path / "w2.xlsx"), most=1)
    back = sinks.read_workbooks(spark, str(tmp_path), "w2*").orderBy("sheet", "row_no").collect()
    assert sorted({r.sheet for r in back}) == sorted(["a", "a (2)", "A (3)", "A (4)", "x" * 31, "x" * 27 + " (2)", "x" * 27 + " (3)", "x" * 27 + " (4)"])
    assert [r.cells for r in back if r.sheet == "a (2)"] == [["year", "quarter", "sheet", "x", "t"], ["2024", "2", "s", None, "é"]]


def test_workbooks_of_periods(spark, tmp_path):
    matrix = spark.createDataFrame([(1, "Ventas", 10.5, None), (2, "Costo", -3.0, 4.0)], "row_no int, label string, 2024_QI double, 2024_QII double")
    sinks.write_workbook({"s": matrix}, str(tmp_path / "w.xlsx"))
    rows = sinks.read_workbooks(spark, str(tmp_path))
    assert sorted(r.period for r in sinks.workbook_periods(rows).collect()) == ["2024_QI", "2024_QII"]
    assert {(r.label, r.period): r.value for r in sinks.workbook_values(rows).collect() if r.value is not None} == {("Ventas", "2024_QI"): 10.5, ("Costo", "2024_QI"): -3.0, ("Costo", "2024_QII"): 4.0}
    (tmp_path / "bad.xlsx").write_bytes(b"no workbook")
    assert sinks.read_workbooks(spark, str(tmp_path)).count() == rows.count()


def test_provenance_and_audit(spark, tmp_path):
    shape = "period string, field string, ord int, source string, ts timestamp"
    prov = spark.createDataFrame([("p", "f", 1, "a", datetime(2024, 1, 2)), ("p", "f", 0, None, None), ("q", "g", 2, "c", None)], shape)
    sinks.write_provenance(prov, str(tmp_path / "p"))
    sinks.write_provenance(prov.where("period = 'q'").withColumn("ord", F.lit(7)), str(tmp_path / "p"))
    back = sinks.read_provenance(spark, str(tmp_path / "p"), shape)
    assert sorted((r.period, r.field, r.ord, r.ts) for r in back.collect()) == [("p", "f", 0, None), ("p", "f", 1, datetime(2024, 1, 2)), ("q", "g", 7, None)]
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "x.json").write_text('{"f": [{"source": "a"}, {"source": "b"}], "g": []}')
    (tmp_path / "m" / "y.json").write_text("[broken")
    maps = sinks.read_provenance_maps(spark, str(tmp_path / "m"), "source: string")
    assert sorted((r.field, r.ord, r.source) for r in maps.collect()) == [("f", 0, "a"), ("f", 1, "b")]
    images = spark.createDataFrame([("d", 1, bytearray(b"x"))], "doc_id string, page_no int, content binary")

    def failing(data):
        raise ValueError("no")

    for n in (1, 2):
        sinks.append_audit(sources.ocr_attempts(images, failing, [lambda data: "text"], 2, wait=0.01), str(tmp_path / "audit"))
        assert spark.read.parquet(str(tmp_path / "audit")).count() == 3 * n
    assert [r.error for r in spark.read.parquet(str(tmp_path / "audit")).where("attempt < 3").select("error").distinct().collect()] == ["no"]


def test_files_of_one_name_stay_apart(spark, tmp_path):
    for folder in ("a", "b"):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "Q1.xml").write_text(f'<x xmlns:k="urn:{folder}"><k:n contextRef="c">{folder}</k:n></x>')
    assert sorted((r.doc_id, r.value) for r in sources.read_facts(spark, str(tmp_path)).collect()) == [("a/Q1", "a"), ("b/Q1", "b")]
    assert sorted((r.doc_id, r.prefix, r.namespace) for r in sources.read_namespaces(spark, f"file://{tmp_path}").collect()) == [("a/Q1", "k", "urn:a"), ("b/Q1", "k", "urn:b")]


def test_tables_and_facts_of_text_files(spark, tmp_path):
    (tmp_path / "d.txt").write_text("Titulo\nVentas  10  5\nCosto\t3\t\n\nsolo  una\n\fx")
    assert [(r.page_no, r.table_idx, r.row_idx, r.cells) for r in sources.read_tables(spark, str(tmp_path)).collect()] == [(1, 0, 0, ["Ventas", "10", "5"]), (1, 0, 1, ["Costo", "3"])]
    assert sources.read_tables(spark, str(tmp_path), pages=[2]).count() == 0
    assert [r.text for r in sources.read_pages(spark, str(tmp_path), pages=[2]).collect()] == ["x"]
    told = sources.read_document_info(spark, str(tmp_path), lambda data: {"Producer": "p"}).first()
    assert (told.doc_id, told.n_pages, told.properties) == ("d", 2, {"Producer": "p"}) and len(told.sha256) == 64


def test_periods_of_listing_pages(spark):
    html = "<a href='b'>2023-12-31</a><a href='a'>31-03-2024</a><a href='c'>2023-09-30</a>"
    pages = spark.createDataFrame([("s", html), ("t", None)], "site string, html string")
    assert [(r.href, r.year, r.quarter) for r in sources.page_periods(pages, ["site"], "html").collect()] == [("a", 2024, 1), ("b", 2023, 4), ("c", 2023, 3)]
    assert {r.site: r.available for r in sources.offers_period(pages, ["site"], "html", 2023, 4).collect()} == {"s": True, "t": False}


def test_streams(spark, tmp_path):
    drop, target, state = (str(tmp_path / n) for n in ("drop", "target", "state"))
    schema = "k string, v int"
    spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], schema).write.json(drop)
    ingest.load_new(spark, drop, schema, target, state, ["k"])
    spark.createDataFrame([("b", 9), ("c", 3)], schema).write.mode("append").json(drop)
    ingest.load_new(spark, drop, schema, target, state, ["k"])
    ingest.load_new(spark, drop, schema, target, state, ["k"])
    assert sorted(map(tuple, spark.read.parquet(target).collect())) == [("a", 1), ("b", 2), ("c", 3)]
