"""Queries of the sheet pipelines end to end: figures from lines, segments, grids and filings, their merge, checks and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan.operators import matching, reshape
from tallyspan.plans import filings, sheets
from tallyspan.sources import rules
from tallyspan.sources.tables import rule_rows, table

# The subtotals of the income statement.
SUBTOTALS = (
    {"description": "gross", "formula": "ganancia_bruta == ingresos_ordinarios + costo_ventas"},
    {"description": "pre_tax", "formula": "ganancia_antes_impuestos == ganancia_bruta + otros_ingresos + otros_egresos_funcion + ingresos_financieros + gastos_admin_ventas + costos_financieros + diferencias_cambio"},
)
#: Figures of a filing from which it counts as read.
ENOUGH_FACTS = 10
_STATEMENT = "resultados"


def _keyed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Keyword and field rules of all sheets, the field named with its sheet, so that one pass serves all of them."""
    name = F.concat_ws("/", "sheet", "field").alias("field")
    return table(spark, sf_dir, "keyword_rule").select(name, "match_words", "exclude_words"), table(spark, sf_dir, "field_rule").select(name, "value_type", "sign")


def _named(values: DataFrame) -> DataFrame:
    part = lambda n: F.split_part("field", F.lit("/"), F.lit(n))
    return values.select("doc_id", part(1).alias("sheet"), part(2).alias("field"), "value")


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.coalesce("page_no", F.lit(0)).alias("page_no"), "text")


def figures_from_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures of every sheet from page texts, typed and signed by the field rules."""
    return _named(sheets.from_lines(_pages(spark, sf_dir), *_keyed(spark, sf_dir)))


def figures_from_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from the right segment of each document: notes, up to a blank line, the first that speaks of debt or else the longest of three lines or more."""
    start, end, tells = F.col("line").rlike("^(Nota|Note) [0-9]+"), F.trim("line") == "", F.lower("line").contains("deuda")
    return _named(sheets.from_statement(_pages(spark, sf_dir), start, end, tells, *_keyed(spark, sf_dir), least=3))


def _grids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as table grids, a table per section of a document's page."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("-"))
    cells = F.array("concepto", *[text(c) for c in ("ytd_actual", "ytd_anterior", "quarter_actual", "quarter_anterior")])
    return table(spark, sf_dir, "line_item").where("concepto is not null").select("doc_id", "page_no", F.col("section").alias("table_idx"), F.col("item_id").alias("row_idx"), cells.alias("cells"))


def figures_from_grids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures of every section from the best table of each document."""
    return sheets.from_grids_by_section(_grids(spark, sf_dir), table(spark, sf_dir, "keyword_rule"), table(spark, sf_dir, "field_rule"))


def table_or_next_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cost note's table on a wanted page of each document or the page after it. Wanted is the page of its items, or the one before where its smallest item id is odd."""
    rows = _grids(spark, sf_dir)
    texts = rows.groupBy("doc_id", "page_no", "table_idx").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("row_idx", matching.table_text(F.col("cells")).alias("t")))), lambda x: x["t"]), "\n").alias("t"))
    wanted = rows.groupBy("doc_id").agg((F.min("page_no") - F.pmod(F.min("row_idx"), F.lit(2))).cast("int").alias("page_no"))
    labels = [r.labels[0] for r in rule_rows(table(spark, sf_dir, "keyword_rule")) if r.section == "nota_21"]
    return matching.best_table_or_next(texts, wanted, ["doc_id"], "page_no", "table_idx", "t", labels, least=2)


def _items(spark: SparkSession, sf_dir: str, section: str | None = None) -> DataFrame:
    """Figures of line items by the keywords of their section."""
    found = filings.sheet_items(spark, sf_dir).select("doc_id", "section", "field", F.col("ytd_actual").cast("double").alias("value"))
    return found if section is None else found.where(F.col("section") == section)


def statement_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The income statement of each document: its filing where enough was read, gaps filled from its line items, else the items."""
    return sheets.combined(filings.mapped_facts(spark, sf_dir), _items(spark, sf_dir, _STATEMENT).select("doc_id", "field", "value"), ENOUGH_FACTS)


def statement_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statement's layout per document, null where a figure is missing."""
    values = statement_figures(spark, sf_dir)
    fields = table(spark, sf_dir, "field_rule").where(F.col("section") == _STATEMENT)
    return sheets.record_rows(values, fields, values)


def _doc_id(segment: Column, year: Column, quarter: Column) -> Column:
    return F.concat(segment, F.lit("_"), year.cast("string"), F.lit("Q"), quarter.cast("string"))


def statement_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All checks of the statement: subtotals by formula, line items against the filing by a table of pairs, and against the tagged copy of the figures as reference."""
    items = _items(spark, sf_dir, _STATEMENT).select("doc_id", "field", "value")
    fields = [r for r in rule_rows(table(spark, sf_dir, "field_rule")) if r.section == _STATEMENT]
    pairs = rules.pair_table(spark, [{"field_name": r.field, "tolerance": 1.0} for r in fields])
    kinds = F.broadcast(spark.createDataFrame([(r.field, r.value_type == "int") for r in fields], "field string, is_int boolean"))
    copy = table(spark, sf_dir, "value_xbrl").where(F.col("segment_id").rlike("^SG-[0-9]{9}$") & (F.col("sheet") == "sheet3") & F.col("value").isNotNull())
    reference = copy.groupBy(_doc_id(F.col("segment_id"), F.col("year"), F.col("quarter")).alias("doc_id"), "field").agg(F.max("value").alias("expected")).join(kinds, "field")
    return sheets.checks(items, reference=reference, other=filings.mapped_facts(spark, sf_dir), formulas=rules.formula_table(spark, list(SUBTOTALS)), pairs=pairs)


def note_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums of each section's figures against the total that the field rules give it, where it is one."""
    fields = rule_rows(table(spark, sf_dir, "field_rule"))
    totals = {s: [r.field for r in fields if r.section == s and r.is_total] for s in {r.section for r in fields}}
    listed = [{"description": s, "total_field": t[0], "sum_fields": [r.field for r in fields if r.section == s and not r.is_total]} for s, t in sorted(totals.items()) if len(t) == 1]
    values = _items(spark, sf_dir).where(F.col("section").isin(*[r["description"] for r in listed])).select("doc_id", "field", "value")
    return sheets.checks(values, sums=rules.sum_table(spark, listed))


def check_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of each document's checks by category with counts, failures and verdict."""
    both = note_checks(spark, sf_dir).unionByName(statement_checks(spark, sf_dir))
    return reshape.sectioned_report(both, ["doc_id"], "category", "rule", sheets.CATEGORIES)


QUERIES = {f.__name__: f for f in (figures_from_lines, figures_from_segments, figures_from_grids, table_or_next_page, statement_figures, statement_records, statement_checks, note_checks, check_report)}
