"""Queries of number parsing, text, periods, selection and validation over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan.functions import numbers, periods, text
from tallyspan.functions.keys import field_name
from tallyspan.operators import formula, merge, reshape, select, validate
from tallyspan.sources.tables import table, with_each


def _order_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long values per order: its total and its lines' prices with discount and tax."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_key"), F.lit("total").alias("field"), F.col("o_totalprice").cast("decimal(18,2)").alias("value"))
    exact = lambda c: F.col(c).cast("decimal(12,2)")  # noqa: E731 - decimals, so that sums don't depend on the order of rows
    price = F.round(exact("l_extendedprice") * (1 - exact("l_discount")) * (1 + exact("l_tax")), 2).cast("decimal(18,2)")
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("order_key"), F.lit("line").alias("field"), price.alias("value"))
    return orders.unionByName(lines)


def reconcile_order_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sum check: an order's lines against its total."""
    rules = spark.createDataFrame([("lines_make_total", "line", False), ("lines_make_total", "total", True)], "rule string, field string, is_total boolean")
    checked = validate.sum_check(_order_values(spark, sf_dir), rules, ["order_key"])
    return checked.select("order_key", "rule", *[F.col(c).cast("double").alias(c) for c in ("expected", "actual", "difference")], "match")


def reconcile_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sources of an order's value: its own total and the sum of its lines."""
    values = _order_values(spark, sf_dir)
    own = values.where("field = 'total'").select("order_key", "value")
    lines = values.where("field = 'line'").groupBy("order_key").agg(F.sum("value").alias("value"))
    found = validate.source_check(own, lines, ["order_key"], 1000.0, ("order", "lines"))
    return found.select("order_key", "source", "match", *[F.col(c).cast("double").alias(c) for c in ("value_a", "value_b", "difference", "value")])


def _line_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag",
        F.round(F.col("l_quantity")).cast("bigint").alias("cantidad"), F.round(F.col("l_extendedprice")).cast("bigint").alias("bruto"),
        F.round(F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("bigint").alias("neto"), F.round(F.col("l_extendedprice") * F.col("l_discount")).cast("bigint").alias("rebaja"),
    )
    names = {n: F.col(n) for n in ("cantidad", "bruto", "neto", "rebaja")}
    return rows.withColumn("c", formula.compile_rule("neto + abs(rebaja) == bruto - cantidad * 2", names, 60))


def formula_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A formula rule compiled to columns."""
    return _line_checks(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_partkey", "c.expected", "c.actual", "c.difference", "c.match")


def validation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks, passes and failures per category."""
    return validate.summary(_line_checks(spark, sf_dir).select("l_returnflag", "c.match"), "l_returnflag").withColumnRenamed("l_returnflag", "category")


def parse_thousands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "provenance").select("prov_id", numbers.parse_thousands(F.col("raw_value")).alias("value"))


def parse_locale_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = table(spark, sf_dir, "provenance").select("prov_id", numbers.parse_locale_decimal(F.col("raw_value")).alias("p"))
    return parsed.select("prov_id", "p.v", "p.is_int")


def parse_mixed_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "kpi_value").select("value_id", numbers.parse_mixed_number(F.col("value_text")).alias("value"))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "raw_line").select("raw_id", F.replace(F.replace(F.replace("payload", F.lit(";"), F.lit(" ")), F.lit("|"), F.lit(" ")), F.lit("\t"), F.lit(" ")).alias("line"))


def normalize_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir).select("raw_id", numbers.normalize_line(F.col("line")).alias("line"))


def number_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number tokens of whole document texts: how many, and all of them joined."""
    tokens = table(spark, sf_dir, "documents").select("doc_id", numbers.number_tokens(F.col("text")).alias("t"))
    return tokens.select("doc_id", F.when(F.col("t").isNotNull(), F.size("t")).alias("n"), F.md5(F.array_join("t", " ")).alias("tokens_md5"))


def current_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir).select("raw_id", numbers.current_value(F.col("line")).alias("value"), numbers.current_value(F.col("line"), 1).alias("second"), numbers.joins_lone_digit(F.col("line")).alias("ambiguous"))


def normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "kpi_value").select("value_id", text.normalize_for_matching(F.col("label")).alias("label"))


def clean_whitespace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "line_item").select("item_id", text.clean_text(F.col("concepto")).alias("concepto"))


def snake_case_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "field_rule").select("sheet", "field", text.snake_case(F.col("label")).alias("snake"), text.format_sheet_name(F.col("field")).alias("title"))


def content_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.content_hash(F.col("text")).alias("sha"))


def scale_floor_trunc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", numbers.scale_floor(F.col("c_acctbal")).alias("floored"), numbers.scale_trunc(F.col("c_acctbal")).alias("truncated"))


def period_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys and labels of order dates in each style."""
    y, q, m = F.year("o_orderdate"), F.quarter("o_orderdate"), F.month("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", periods.format_period(y, q).alias("quarter_key"), periods.format_period(y, q, style="display").alias("quarter_label"), periods.format_period(y, m, "monthly").alias("month_key"),
        periods.format_period(y, F.lit(1), "yearly", "display").alias("year_label"), periods.file_name("estados_{year}_{roman}.pdf", y, q).alias("file"),
    )


def period_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = table(spark, sf_dir, "provenance").select("prov_id", periods.parse_period(F.col("period")).alias("p"), periods.period_sort_key(F.col("period")).alias("k"))
    return parsed.select("prov_id", F.col("p.year").alias("year"), F.col("p.period").alias("quarter"), F.col("k.year").alias("sort_year"), F.col("k.period").alias("sort_period"))


def provenance_primary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The primary source of each field: most confident, XML first, then in order of delivery."""
    rows = table(spark, sf_dir, "provenance").select("segment_id", "period", "field", "prov_id", "source_type", F.coalesce("confidence", F.lit(-1.0)).alias("c"), "ord")
    order = [-F.col("c"), (F.coalesce(F.col("source_type"), F.lit("")) != "xml").cast("int"), F.col("ord"), F.col("prov_id")]
    return select.pick_first(rows, ["segment_id", "period", "field"], order, ["prov_id", "source_type"])


def fallback_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user, the value of the most wanted kind of event that has one."""
    wanted = spark.createDataFrame([("purchase", 1), ("click", 2), ("view", 3)], "event_type string, want int")
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "value")
    return select.fallback_chain(events, wanted, "event_type", "want", ["user_id"], [F.col("event_id")], "value")


def top_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hundred greatest orders; the limit is the report's own."""
    return select.top_rows(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), F.col("o_orderkey")], 100)


def reference_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean sale price per unit of each part against its list price, by relative tolerance."""
    parts = table(spark, sf_dir, "part").select("p_partkey", F.col("p_retailprice").alias("expected"), F.lit(False).alias("is_int"))
    sold = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.round(F.sum("l_extendedprice") / F.sum("l_quantity"), 4).alias("value"))
    return validate.reference_check(parts, sold, ["p_partkey"]).select("p_partkey", "expected", "value", F.round("difference", 4).alias("difference"), "match")


def section_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of every section that the field rules give one total, against its total row.

    Sections without a total have nothing to check, and several totals are
    subtotals, not the section's sum.
    """
    totals = table(spark, sf_dir, "field_rule").where("is_total").groupBy("section").agg(F.count("*").alias("n")).where("n = 1")
    items = table(spark, sf_dir, "line_item").join(F.broadcast(totals.select("section")), "section", "left_semi")
    named = items.select("doc_id", "section", F.regexp_replace("concepto", r"(?i)\bsuma\b", "Total").alias("concepto"), "ytd_actual")
    return validate.section_total(named, ["doc_id", "section"], "concepto", "ytd_actual")


def coalesce_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two copies of the figures merged, the tagged one first."""
    one = lambda t: table(spark, sf_dir, t).groupBy("segment_id", "year", "quarter", field_name(F.col("field")).alias("field")).agg(F.max("value").alias("value"), F.max("note_ref").alias("note_ref"))
    return merge.coalesce_merge(one("value_xbrl"), one("value_pdf"), ["segment_id", "year", "quarter", "field"], ["value", "note_ref"])


# The quarters of the order tables.
ORDER_PERIODS = tuple(f"{y}_Q{q}" for y in range(1995, 2002) for q in range(1, 5))


def _by_quarter(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.concat(F.year("o_orderdate").cast("string"), F.lit("_Q"), F.quarter("o_orderdate").cast("string"))
    return table(spark, sf_dir, "orders").groupBy(F.col("o_orderstatus").alias("status"), key.alias("period")).agg(F.round(F.sum("o_totalprice"), 2).alias("value"))


def period_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.period_matrix(_by_quarter(spark, sf_dir), ["status"], "period", "value", ORDER_PERIODS)


def matrix_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.unpivot_matrix(period_matrix(spark, sf_dir), ["status"], ORDER_PERIODS, keep_nulls=False)


def incremental_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarters known so far, and those of a later load that are new."""
    values = _by_quarter(spark, sf_dir)
    known = values.where("period < '1998_Q1'")
    return merge.append_new(known, values.where("period >= '1997_Q3'").withColumn("value", -F.col("value")), ["status", "period"])


def layout_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of a sheet's layout in every year and quarter with the sum of their figures, null where there are none. Fields count however spelled."""
    values = table(spark, sf_dir, "value_pdf").withColumn("field", field_name(F.col("field")))
    layout = with_each(values.select("year", "quarter").distinct(), table(spark, sf_dir, "field_rule").select("sheet", "field", "row_no", "label"))
    sums = values.groupBy("sheet", "field", "year", "quarter").agg(F.count("value").alias("n"), F.round(F.sum("value"), 2).alias("total"))
    return merge.layout_map(layout, sums, ["sheet", "field", "year", "quarter"], "row_no")


def missing_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without an embedding."""
    return merge.missing_keys(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("k")), table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("k")), ["k"])


def valid_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings whose id is a document's."""
    return merge.keep_valid(table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("k"), "label"), table(spark, sf_dir, "documents").select(F.col("doc_id").alias("k")), ["k"])


def period_cross(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every year of the orders with each quarter-end month."""
    years = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year")).distinct()
    months = spark.createDataFrame([(m, m // 3 if m % 3 == 0 else None) for m in range(1, 13)], "month int, quarter int")
    return merge.period_cross(years, months)


def normalize_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A delivered table with cleaned names, its texts read as numbers and time stamps."""
    raw = table(spark, sf_dir, "kpi_value").select(F.col("value_id").alias("Value ID"), F.col("value_text").alias("Valor (texto)"), F.col("loaded_at").cast("string").alias("Fecha de carga"))
    return reshape.normalize_frame(raw, ["Fecha de carga"], ["Valor (texto)"])


def report_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report lines of the checks of all sections' totals."""
    checks = section_total(spark, sf_dir).withColumnsRenamed({"calculated": "expected", "reported": "actual"})
    return reshape.report_rows(checks, "section", "doc_id")


def split_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of each segment's documents before and from the first page that speaks of the auditors."""
    pages = table(spark, sf_dir, "documents").select("segment_id", "doc_id", "page_no", "text")
    return reshape.split_document(pages, ["segment_id"], "page_no", F.lower("text").contains("auditores")).select("doc_id", "segment_id", "part")


def combined_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding joined end to end with the one of its id in a second table, here the whole table again: width and last element."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    both = reshape.combine_vectors([rows, rows], "vec_id", "embedding")
    return both.select("vec_id", F.size("embedding").alias("width"), F.round(F.element_at("embedding", -1), 6).alias("last"))


QUERIES = {
    f.__name__: f
    for f in (
        reconcile_order_totals, reconcile_sources, formula_check, validation_summary, parse_thousands, parse_locale_decimal, parse_mixed_number, normalize_line, number_tokens, current_value,
        normalize_text, clean_whitespace, snake_case_names, content_hash, scale_floor_trunc, period_key, period_parse, provenance_primary, fallback_chain, top_orders, reference_check, section_total,
        coalesce_merge, period_matrix, matrix_unpivot, incremental_append, layout_map, missing_keys, valid_keys, period_cross, normalize_frame, report_rows, split_documents, combined_vectors,
    )
}
