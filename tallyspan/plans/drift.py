"""Queries of problem 4 over sheet_file."""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan.functions.keys import period_quarter, period_year
from tallyspan.operators import drift
from tallyspan.sources.tables import rule_rows, table


def _known(spark: SparkSession, sf_dir: str) -> dict[str, set[str]]:
    fields: dict[str, set[str]] = defaultdict(set)
    for r in rule_rows(table(spark, sf_dir, "field_rule")):
        fields[r.sheet].add(r.field)
    return dict(fields)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each change of layout between consecutive files of a series."""
    files = table(spark, sf_dir, "sheet_file")
    known = set().union(*_known(spark, sf_dir).values())
    name = F.regexp_replace("file_name", r"^[A-Za-z]+[0-9]+_|\.json$", "")
    order = [period_year(name), period_quarter(name), F.col("written_at")]
    return drift.schema_changes(files, ["filer_id", "segment_id", "sheet"], order, known)


def p4_unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All files in one layout: a row per file and field."""
    files = table(spark, sf_dir, "sheet_file").select("file_id", "filer_id", "segment_id", "sheet", "content")
    return drift.unified_rows(files, ["file_id", "filer_id", "segment_id", "sheet"], _known(spark, sf_dir), "sheet")
