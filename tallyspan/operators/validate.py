"""Checks of figures against sums, other sources, formulas and reference values, with stated policies for nulls and signs.

Each returns long rows, so that reports are plain aggregations.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspan.operators.formula import compile_rule, variables
from tallyspan.sources.tables import broadcast_if_small, rule_rows


def difference(a: Column, b: Column, signed: bool = True) -> Column:
    """Absolute difference; unsigned compares magnitudes. Null where either is null."""
    return F.abs(a - b) if signed else F.abs(F.abs(a) - F.abs(b))


def tolerance_match(a: Column, b: Column, tolerance: Column | float, nulls: str = "pass", signed: bool = False) -> Column:
    """Whether two figures agree. ``nulls``: ``pass``, ``fail``, ``zero`` (count as 0) or ``skip`` (null result) where one is missing."""
    t = tolerance if isinstance(tolerance, Column) else F.lit(float(tolerance))
    if nulls == "zero":
        a, b = F.coalesce(a, F.lit(0)), F.coalesce(b, F.lit(0))
    within = difference(a, b, signed) <= t
    return {"pass": F.coalesce(within, F.lit(True)), "fail": F.coalesce(within, F.lit(False)), "zero": within, "skip": within}[nulls]


def sum_check(values: DataFrame, rules: DataFrame, key: Sequence[str], tolerance: float = 1.0, signed: bool = False) -> DataFrame:
    """Sums of parts against totals. ``values``: key, field, value; ``rules``: rule, field, is_total, and optionally tolerance.

    Null parts count as 0 and a null or absent total passes. One aggregation
    over key and rule with map-side combine; the rules are broadcast.
    """
    own = F.coalesce(F.col("tolerance"), F.lit(tolerance)) if "tolerance" in rules.columns else F.lit(tolerance)
    joined = values.select(*key, "field", "value").join(broadcast_if_small(rules), "field")
    summed = joined.groupBy(*key, "rule").agg(
        F.sum(F.when(~F.col("is_total"), F.coalesce("value", F.lit(0)))).alias("expected"),
        F.max(F.when(F.col("is_total"), F.col("value"))).alias("actual"),
        F.max(own).alias("tolerance"),
    )
    expected = F.coalesce("expected", F.lit(0))
    return summed.select(
        *key, "rule", expected.alias("expected"), "actual", "tolerance",
        F.coalesce(difference(expected, F.col("actual"), signed), F.lit(0)).alias("difference"),
        tolerance_match(expected, F.col("actual"), F.col("tolerance"), "pass", signed).alias("match"),
    )


def source_check(a: DataFrame, b: DataFrame, key: Sequence[str], tolerance: float = 1.0, names: tuple[str, str] = ("pdf", "xbrl")) -> DataFrame:
    """Two sources of one figure (column ``value``) by magnitude. Keys null on both sides give no row; on one side they match, with source ``<name>_only``.

    ``value`` is the reconciled figure: the first source's, else the second's.
    """
    joined = a.select(*key, F.col("value").alias("__a")).join(b.select(*key, F.col("value").alias("__b")), list(key), "full")
    va, vb = F.col("__a"), F.col("__b")
    source = F.when(va.isNotNull() & vb.isNotNull(), "both").when(va.isNotNull(), f"{names[0]}_only").when(vb.isNotNull(), f"{names[1]}_only")
    return joined.where(va.isNotNull() | vb.isNotNull()).select(
        *key, va.alias("value_a"), vb.alias("value_b"), source.alias("source"),
        F.coalesce(difference(va, vb, False), F.lit(0)).alias("difference"),
        tolerance_match(va, vb, tolerance).alias("match"), F.coalesce(va, vb).alias("value"),
    )


def reference_check(reference: DataFrame, actual: DataFrame, key: Sequence[str], absolute: float = 1.0, relative: float = 0.01) -> DataFrame:
    """Actual figures against verified ones. Whole-number fields by absolute, others by relative tolerance (skipped where the reference is 0); a missing actual fails.

    ``reference``: key, expected, is_int. ``actual``: key, value.
    """
    joined = reference.join(actual.select(*key, "value"), list(key), "left")
    off = F.abs(F.col("value") - F.col("expected"))
    fine = F.when(F.col("is_int"), off <= absolute).when(F.col("expected") == 0, True).otherwise(off / F.abs("expected") <= relative)
    return joined.select(*key, "expected", "value", off.alias("difference"), F.coalesce(fine & F.col("value").isNotNull(), F.lit(False)).alias("match"))


def section_total(items: DataFrame, key: Sequence[str], label: str, value: str, marker: str = "total") -> DataFrame:
    """Item sums against the section's total row, exactly. Rows whose label holds the marker are totals; a missing total fails."""
    is_total = F.lower(F.col(label)).contains(marker)
    summed = items.groupBy(*key).agg(
        F.sum(F.when(~F.coalesce(is_total, F.lit(False)), F.coalesce(value, F.lit(0)))).alias("calculated"),
        F.max(F.when(is_total, F.col(value))).alias("reported"),
    )
    calculated = F.coalesce("calculated", F.lit(0))
    return summed.select(*key, calculated.alias("calculated"), "reported", (F.col("reported") - calculated).alias("difference"), F.coalesce(F.col("reported") == calculated, F.lit(False)).alias("match"))


def formula_checks(values: DataFrame, rules: DataFrame, key: Sequence[str]) -> DataFrame:
    """``(key, rule, expected, actual, difference, match, missing)`` of formula rules over long figures ``(key, field, value)``.

    ``rules``: rule, formula, tolerance, a rule table. The figures that the
    formulas name are gathered per key in one aggregation with map-side
    combine, and every rule is an expression over them; of a repeated figure
    the greatest counts. A rule with a missing figure passes.
    """
    listed = rule_rows(rules)
    wanted = list(dict.fromkeys(v for r in listed for v in variables(r.formula)))
    wide = values.where(F.col("field").isin(*wanted)).groupBy(*key).agg(*[F.max(F.when(F.col("field") == v, F.col("value").cast("double"))).alias(f"__v{i}") for i, v in enumerate(wanted)])
    names = {v: F.col(f"__v{i}") for i, v in enumerate(wanted)}
    checks = []
    for r in listed:
        c = compile_rule(r.formula, names, r.tolerance)
        checks.append(F.struct(F.lit(r.rule).alias("rule"), *[c[n].cast("double").alias(n) for n in ("expected", "actual", "difference")], c["match"].alias("match"), c["missing"].alias("missing")))
    return wide.select(*key, F.inline(F.array(*checks)))


def pair_checks(values: DataFrame, other: DataFrame, pairs: DataFrame, key: Sequence[str], names: tuple[str, str] = ("pdf", "xbrl")) -> DataFrame:
    """``(key, rule, value_a, value_b, source, difference, match)``: figures of one source against those that a rule table pairs them with in another, by magnitude within the rule's tolerance.

    ``pairs``: rule, field, other, tolerance. A figure that only one source
    has matches, and pairs that neither has give no row.
    """
    small = broadcast_if_small(pairs)
    a = values.select(*key, "field", F.col("value").alias("__a")).join(small.select("rule", "field", "tolerance"), "field").select(*key, "rule", "tolerance", "__a")
    b = other.select(*key, F.col("field").alias("other"), F.col("value").alias("__b")).join(small.select("rule", "other", F.col("tolerance").alias("__t")), "other").select(*key, "rule", "__t", "__b")
    va, vb = F.col("__a"), F.col("__b")
    source = F.when(va.isNotNull() & vb.isNotNull(), "both").when(va.isNotNull(), f"{names[0]}_only").otherwise(f"{names[1]}_only")
    joined = a.join(b, [*key, "rule"], "full").where(va.isNotNull() | vb.isNotNull())
    return joined.select(*key, "rule", va.alias("value_a"), vb.alias("value_b"), source.alias("source"), F.coalesce(difference(va, vb, False), F.lit(0)).alias("difference"), tolerance_match(va, vb, F.coalesce("tolerance", "__t")).alias("match"))


def summary(checks: DataFrame, category: str) -> DataFrame:
    """Count, passed and whether any failed, per category."""
    return checks.groupBy(category).agg(F.count("*").alias("n"), F.count_if("match").alias("passed"), F.bool_or(~F.col("match")).alias("has_failures"))


def status_text(match: Column, a: Column, b: Column, diff: Column) -> Column:
    """One line of a report."""
    return F.when(match, F.concat(F.lit("ok "), F.format_number(a, 0))).otherwise(F.concat(F.lit("mismatch "), F.format_number(a, 0), F.lit(" vs "), F.format_number(b, 0), F.lit(" (difference "), F.format_number(diff, 0), F.lit(")")))
