"""Merging sources per key, incremental appends, and wide period matrices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.sources.tables import with_each


def coalesce_merge(first: DataFrame, second: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Full outer merge where the first source's values win and the second fills nulls; ``source`` says who contributed."""
    a = first.select(*key, *[F.col(c).alias(f"a_{c}") for c in columns], F.lit(True).alias("__a"))
    b = second.select(*key, *[F.col(c).alias(f"b_{c}") for c in columns], F.lit(True).alias("__b"))
    source = F.when(F.col("__a") & F.col("__b"), "both").when(F.col("__a"), "first").otherwise("second")
    return a.join(b, list(key), "full").select(*key, *[F.coalesce(f"a_{c}", f"b_{c}").alias(c) for c in columns], source.alias("source"))


def prefer(ranked: Sequence[DataFrame], key: Sequence[str]) -> DataFrame:
    """Rows of the first source that has the key at all (source strategy: one source, the others as fallback)."""
    out = ranked[0]
    for nxt in ranked[1:]:
        out = out.unionByName(nxt.join(out.select(*key).distinct(), list(key), "left_anti"))
    return out


def append_new(known: DataFrame, fresh: DataFrame, key: Sequence[str]) -> DataFrame:
    """Known rows, and the fresh ones of keys not yet known; running it twice changes nothing."""
    return known.unionByName(fresh.join(known.select(*key).distinct(), list(key), "left_anti"))


def missing_keys(wanted: DataFrame, have: DataFrame, key: Sequence[str]) -> DataFrame:
    return wanted.join(have, list(key), "left_anti")


def keep_valid(rows: DataFrame, valid: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows whose key is valid; orphans go."""
    return rows.join(valid, list(key), "left_semi")


def layout_map(layout: DataFrame, values: DataFrame, on: Sequence[str], order: str) -> DataFrame:
    """The layout's rows with their values, null where there is none, in the order of a numeric row key."""
    return layout.join(values, list(on), "left").orderBy(F.col(order).cast("int"))


def period_matrix(values: DataFrame, rows: Sequence[str], period: str, value: str, periods: Sequence[str]) -> DataFrame:
    """Wide matrix, a column per listed period in that order; the listed periods spare the pass that would find them."""
    return values.groupBy(*rows).pivot(period, list(periods)).agg(F.max(value))


def known_periods(values: DataFrame, year: str, quarter: str) -> DataFrame:
    return values.select(year, quarter).distinct().orderBy(year, quarter)


def unpivot_matrix(matrix: DataFrame, rows: Sequence[str], periods: Sequence[str], keep_nulls: bool = True) -> DataFrame:
    """Long rows ``(rows, period, value)`` of a wide matrix."""
    long = matrix.unpivot(list(rows), list(periods), "period", "value")
    return long if keep_nulls else long.where("value is not null")


def period_cross(years: DataFrame, months: DataFrame) -> DataFrame:
    """Every year with every quarter-end month. ``months``: (month, quarter), a rule table; months without quarter are dropped."""
    return with_each(years, months.where("quarter is not null"))
