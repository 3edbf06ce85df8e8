"""Pipelines that turn page texts, table grids and tagged filings into long sheet figures ``(doc_id, field, value)``.

Rules are data: the field, keyword and fact mapping tables. Each pipeline scans
its documents once and shuffles on the document only; sources of one sheet are
merged and checked by the general operators.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspan.functions.numbers import current_value
from tallyspan.operators import filings, grids, matching, merge, segments, validate
from tallyspan.operators.select import pick_first
from tallyspan.sources.tables import broadcast_if_small, rule_rows, with_each


def typed(values: DataFrame, fields: DataFrame) -> DataFrame:
    """Values of the known fields by their declared type: whole numbers are cut off at the point, and signs follow the rule (``negative`` fields are made negative)."""
    rules = broadcast_if_small(fields.select("field", "value_type", "sign"))
    whole = F.when(F.col("value_type") == "int", F.col("value").cast("bigint").cast("double")).otherwise(F.col("value"))
    signed = F.when((F.col("sign") == "negative") & (whole > 0), -whole).otherwise(whole)
    return values.join(rules, "field").select("doc_id", "field", signed.alias("value"))


def from_lines(pages: DataFrame, keywords: DataFrame, fields: DataFrame) -> DataFrame:
    """Figures from page texts ``(doc_id, page_no, text)``: of each field the first line, over all pages in order, with a keyword, no excluded word, and a value."""
    lines = segments.text_lines(pages, ["doc_id", "page_no"], "text")
    place = F.struct("page_no", "line_no").alias("place")
    found = matching.keyword_values(lines.select("doc_id", place, "line"), ["doc_id"], "place", "line", current_value(F.col("line")), keywords.select("field", "match_words", "exclude_words"))
    return typed(found, fields)


def from_statement(pages: DataFrame, start: Column, end: Column, tells: Column, keywords: DataFrame, fields: DataFrame, least: int = 10) -> DataFrame:
    """Figures from the right segment of a document: segments lie between start and end lines; the first with a telling line counts, else the longest. Conditions are over ``line``."""
    lines = segments.text_lines(pages, ["doc_id", "page_no"], "text")
    marked = segments.segment_rows(lines, ["doc_id"], ["page_no", "line_no"], start, end, F.col("page_no"))
    chosen = segments.choose_segment(marked, ["doc_id"], tells, least).select("doc_id", "seg_no")
    inside = marked.join(chosen, ["doc_id", "seg_no"], "left_semi").select("doc_id", F.struct("page_no", "line_no").alias("place"), "line")
    found = matching.keyword_values(inside, ["doc_id"], "place", "line", current_value(F.col("line")), keywords.select("field", "match_words", "exclude_words"))
    return typed(found, fields)


def from_grids(rows: DataFrame, keywords: DataFrame, fields: DataFrame, section: str, unique: Sequence[str] = (), exclude: Sequence[str] = (), least: int = 3, compact: bool = False) -> DataFrame:
    """Figures of a section from table grids ``(doc_id, page_no, table_idx, row_idx, cells)``.

    The best scored table of a document counts, the first among equals. Its
    rows are parsed by the section's labels; the first value of a row is the
    current figure. Two rows of one field: the later wins. The section's total
    field takes the total row.
    """
    rules = sorted((r for r in rule_rows(keywords) if r.section == section), key=lambda r: r.rule_ord)
    labels = [x for r in rules for x in (r.labels or [])]
    texts = rows.groupBy("doc_id", "page_no", "table_idx").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("row_idx", matching.table_text(F.col("cells")).alias("t")))), lambda x: x["t"]), "\n").alias("t"))
    scored = texts.withColumn("at", F.struct("page_no", "table_idx"))
    best = matching.best_table(scored, ["doc_id"], "at", "t", labels, unique, exclude, least).select("doc_id", "at.page_no", "at.table_idx")
    chosen = rows.join(best, ["doc_id", "page_no", "table_idx"], "left_semi")
    parsed = grids.parse_grid(chosen, ["doc_id"], "row_idx", "cells", labels, compact)
    totals = [r.field for r in rule_rows(fields) if r.section == section and r.is_total]
    named = matching.match_keywords(F.col("concepto"), [(r.field, r.match_words, r.exclude_words) for r in rules if r.field not in totals])
    is_total = F.lower("concepto").startswith("total") | F.lower("concepto").startswith("suma")
    field = F.when(is_total, F.lit(totals[0])) if totals else F.lit(None).cast("string")
    valued = parsed.select("doc_id", "row_idx", "line", F.coalesce(field, named).alias("field"), F.get("values", F.lit(0)).cast("double").alias("value")).where("field is not null")
    last = pick_first(valued, ["doc_id", "field"], [-F.col("row_idx"), -F.col("line")], ["value"], F.col("value").isNotNull())
    return typed(last, fields)


def from_grids_by_section(rows: DataFrame, keywords: DataFrame, fields: DataFrame, least: int = 3) -> DataFrame:
    """``(doc_id, section, field, value)``: from_grids for every section of the rules in one pass: the texts of the tables are made once and scored for each section, and a table's rows are parsed by the sections it was chosen for."""
    rules: dict[str, list] = {}
    for r in sorted(rule_rows(keywords), key=lambda r: r.rule_ord):
        rules.setdefault(r.section, []).append(r)
    labels = {s: [x for r in rs for x in (r.labels or [])] for s, rs in rules.items()}
    totals: dict[str, list[str]] = {}
    for r in sorted(rule_rows(fields), key=lambda r: r.rule_ord):
        if r.is_total:
            totals.setdefault(r.section, []).append(r.field)
    texts = rows.groupBy("doc_id", "page_no", "table_idx").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("row_idx", matching.table_text(F.col("cells")).alias("t")))), lambda x: x["t"]), "\n").alias("t"))
    scores = F.array(*[F.struct(F.lit(s).alias("section"), matching.score_table(F.col("t"), ls).alias("score")) for s, ls in labels.items()])
    scored = texts.select("doc_id", F.struct("page_no", "table_idx").alias("at"), F.inline(scores)).where(F.col("score") >= least)
    best = pick_first(scored, ["doc_id", "section"], [-F.col("score"), F.col("at")], ["at"]).select("doc_id", "section", "at.page_no", "at.table_idx")
    chosen = rows.join(best, ["doc_id", "page_no", "table_idx"])
    parsed = grids.parse_grid(chosen, ["doc_id", "section"], "row_idx", "cells", labels, section="section")
    by_words = {s: matching.match_keywords(F.col("concepto"), [(r.field, r.match_words, r.exclude_words) for r in rs if r.field not in totals.get(s, ())]) for s, rs in rules.items()}
    is_total = F.lower("concepto").startswith("total") | F.lower("concepto").startswith("suma")
    total = matching.of_section(F.col("section"), {s: F.lit(t[0]) for s, t in totals.items()})
    named = F.coalesce(F.when(is_total, total), matching.of_section(F.col("section"), by_words))
    valued = parsed.select("doc_id", "section", "row_idx", "line", named.alias("field"), F.get("values", F.lit(0)).cast("double").alias("value")).where("field is not null")
    last = pick_first(valued, ["doc_id", "section", "field"], [-F.col("row_idx"), -F.col("line")], ["value"], F.col("value").isNotNull())
    kinds = broadcast_if_small(fields.select("section", "field", "value_type", "sign"))
    whole = F.when(F.col("value_type") == "int", F.col("value").cast("bigint").cast("double")).otherwise(F.col("value"))
    signed = F.when((F.col("sign") == "negative") & (whole > 0), -whole).otherwise(whole)
    return last.join(kinds, ["section", "field"]).select("doc_id", "section", "field", signed.alias("value"))


def from_filings(facts: DataFrame, contexts: DataFrame, mappings: DataFrame, year: Column, quarter: Column, factor: int = 1000) -> DataFrame:
    """Figures from tagged filings: each mapped field in the context chosen by its type; an instant field not found in the yearly context in the first instant of the year."""
    duration = filings.chosen_context(contexts, year, quarter)
    instant = filings.chosen_context(contexts, year, quarter, yearly=True).unionByName(filings.instant_of_year(contexts, year))
    return filings.mapped_values(facts, mappings, duration, instant, factor).select("doc_id", "field", "value")


def enough(values: DataFrame, least: int) -> DataFrame:
    """Documents with at least ``least`` figures; a source with fewer counts as not read."""
    return values.where("value is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where(F.col("n") >= least).select("doc_id")


def combined(first: DataFrame, second: DataFrame, least_first: int = 1, fill: bool = True) -> DataFrame:
    """Figures of the first source where it was read well enough, else of the second; ``fill``: the second fills the first's gaps, field by field."""
    good = first.join(enough(first, least_first), "doc_id", "left_semi")
    if fill:
        return merge.coalesce_merge(good, second, ["doc_id", "field"], ["value"]).select("doc_id", "field", "value", "source")
    other = second.join(good.select("doc_id").distinct(), "doc_id", "left_anti")
    return good.withColumn("source", F.lit("first")).unionByName(other.withColumn("source", F.lit("second")))


#: Order of the categories of checks in reports.
CATEGORIES = ("sum", "formula", "source", "pair", "reference")


def checks(values: DataFrame, sums: DataFrame | None = None, reference: DataFrame | None = None, other: DataFrame | None = None, tolerance: float = 1.0, formulas: DataFrame | None = None, pairs: DataFrame | None = None) -> DataFrame:
    """Long check rows ``(category, doc_id, rule, expected, actual, difference, match)`` of the groups whose rules are given: sums, formulas, the other source field by field or by a table of pairs, and verified values."""
    shape = ["doc_id", "rule", *[F.col(c).cast("double").alias(c) for c in ("expected", "actual", "difference")], "match"]
    found = []
    if sums is not None:
        found.append(("sum", validate.sum_check(values, sums, ["doc_id"], tolerance)))
    if formulas is not None:
        found.append(("formula", validate.formula_checks(values, formulas, ["doc_id"])))
    sides = {"value_a": "expected", "value_b": "actual"}
    if other is not None and pairs is not None:
        found.append(("pair", validate.pair_checks(values, other, pairs, ["doc_id"]).withColumnsRenamed(sides)))
    elif other is not None:
        found.append(("source", validate.source_check(values, other, ["doc_id", "field"], tolerance).withColumnsRenamed(sides | {"field": "rule"})))
    if reference is not None:
        found.append(("reference", validate.reference_check(reference, values, ["doc_id", "field"]).withColumnsRenamed({"field": "rule", "value": "actual"})))
    return reduce(DataFrame.unionByName, [d.select(F.lit(category).alias("category"), *shape) for category, d in found])


def record_rows(values: DataFrame, fields: DataFrame, docs: DataFrame) -> DataFrame:
    """The sheet's layout per document, null where a figure is missing, with its row number and label."""
    layout = with_each(docs.select("doc_id").distinct(), fields.select("field", "row_no", "label"))
    return layout.join(values.select("doc_id", "field", "value"), ["doc_id", "field"], "left").select("doc_id", "row_no", "label", "field", "value")
