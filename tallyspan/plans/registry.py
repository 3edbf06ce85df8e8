"""All queries of the core with their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyspan.plans import drift, figures, figures_sql, filings, filings_sql, pieces, pipelines, pipelines_sql, quality, quality_sql, units

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    "p1_found": units.p1_found,
    "p1_converted": units.p1_converted,
    "p1_spellings": units.p1_spellings,
    "p4_found": drift.p4_found,
    "p4_unified": drift.p4_unified,
    "p5_found": quality.p5_found,
    "p5_line_items": quality.p5_line_items,
    "p5_source_records": quality.p5_source_records,
    "p6_found": quality.p6_found,
    "p6_comparison": quality.p6_comparison,
    **figures.QUERIES,
    **filings.QUERIES,
    **pipelines.QUERIES,
    **pieces.QUERIES,
}

SQL: dict[str, str] = {**quality_sql.SQL, **figures_sql.SQL, **filings_sql.SQL, **pipelines_sql.SQL, **pieces.SQL}
