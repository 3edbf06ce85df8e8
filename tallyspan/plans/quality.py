"""Queries of problems 5 and 6."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan.functions.keys import coded_id, field_name
from tallyspan.operators import badrows as B
from tallyspan.operators.diff import FieldRule, compare_copies
from tallyspan.sources.tables import rule_rows, table


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.classify(table(spark, sf_dir, "raw_line").select("raw_id", "record_kind", "sep", "payload"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each line that isn't valid with the first reason that applies."""
    return B.invalid_rows(_lines(spark, sf_dir), ["raw_id"])


def p5_line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid line items as typed rows."""
    return B.valid_rows(_lines(spark, sf_dir), B.LINE_ITEM, ["raw_id"])


def p5_source_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid source records as typed rows."""
    return B.valid_rows(_lines(spark, sf_dir), B.SOURCE_INFO, ["raw_id"])


def _compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = [(r.sheet, r.field, 0.001 if r.value_type == "float" else 1.0) for r in rule_rows(table(spark, sf_dir, "field_rule"))]
    allowed = F.broadcast(spark.createDataFrame(kinds, "sheet string, field string, __allowed double"))
    keys = {
        "segment_id": coded_id(F.col("segment_id"), "SG", 9),
        "year": F.col("year").cast("bigint"),
        "quarter": F.col("quarter").cast("bigint"),
        "sheet": field_name(F.col("sheet")),
        "field": field_name(F.col("field")),
    }
    rules = [
        FieldRule("value", "magnitude", F.coalesce(F.col("__allowed"), F.lit(0.001))),
        FieldRule("period_type", "text"),
        FieldRule("xbrl_available"),
        FieldRule("note_ref", "text"),
    ]
    pdf, xbrl = table(spark, sf_dir, "value_pdf"), table(spark, sf_dir, "value_xbrl")
    return compare_copies(pdf, xbrl, keys, rules, "loaded_at", ("pdf", "xbrl"), (allowed, ["sheet", "field"]))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures only one copy has, and every field that differs."""
    return _compared(spark, sf_dir).select("segment_id", "year", "quarter", "sheet", "field", "difference")


def p6_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same differences with both values side by side as text, figures with six decimals."""
    shown = lambda c: F.when(F.col("difference") == "value", F.col(c).try_cast("double").cast("decimal(38,6)").cast("string")).otherwise(F.col(c)).alias(c)
    return _compared(spark, sf_dir).select("segment_id", "year", "quarter", "sheet", "field", "difference", shown("value_a"), shown("value_b"), "match")
