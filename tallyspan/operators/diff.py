"""Problem 6: differences between two copies of one dataset, field by field.

The sides are tagged and united, grouped once by key, one struct is kept per
side, and the structs are compared by expressions generated from a list of
field rules. There is one shuffle, on the key, after a map-side combine: a key
that holds a third of all rows reaches the reducer as one row per map task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspan.functions.text import blank_to_null


@dataclass(frozen=True)
class FieldRule:
    """How one column is compared.

    kind ``exact``: null equals null only. ``text``: without case and outer
    blanks, a blank being null. ``magnitude``: differ when just one is null or
    the absolute values are more than ``tolerance`` apart, a column expression
    over the key columns or a number.
    """

    column: str
    kind: str = "exact"
    tolerance: Column | float = 0.0


#: Slack for binary fractions, so that 1.001 against 1.000 is within 0.001.
ROUNDING = 1e-9


def differs(a: Column, b: Column, rule: FieldRule) -> Column:
    if rule.kind == "text":
        clean = lambda c: F.lower(blank_to_null(c))
        return ~clean(a).eqNullSafe(clean(b))
    if rule.kind == "magnitude":
        tolerance = rule.tolerance if isinstance(rule.tolerance, Column) else F.lit(float(rule.tolerance))
        apart = F.abs(F.abs(a.cast("double")) - F.abs(b.cast("double"))) > tolerance + F.lit(ROUNDING)
        return F.when(a.isNull() & b.isNull(), False).when(a.isNull() | b.isNull(), True).otherwise(apart)
    return ~a.eqNullSafe(b)


def compare_copies(
    a: DataFrame,
    b: DataFrame,
    keys: dict[str, Column],
    rules: list[FieldRule],
    latest: str | None = None,
    names: tuple[str, str] = ("a", "b"),
    lookup: tuple[DataFrame, list[str]] | None = None,
) -> DataFrame:
    """One row per key and difference, with the value of either side as text.

    ``keys`` maps output names to expressions over the input columns, so that
    spellings are unified before grouping; null keys form a key of their own.
    Of several rows of a key on one side the one with the greatest ``latest``
    counts (null is the oldest); among equals the greatest by the compared
    columns in the order of ``rules``, so the choice doesn't depend on row
    order. Result: the keys, ``difference`` (``only_<name>`` or the column),
    ``value_a``, ``value_b``, ``match`` (always false here). Empty inputs give
    an empty result; other columns of the inputs are ignored, so clashing
    names do no harm.

    ``lookup``: a small table joined on key columns after grouping, whose
    columns tolerances may use.
    """
    columns = [r.column for r in rules]
    order = ([latest] if latest else []) + columns
    sides = []
    for side, df in enumerate((a, b)):
        inner = F.struct(*[df[c].alias(f"o{i}_{c}") for i, c in enumerate(order)])
        sides.append(df.select(*[e.alias(k) for k, e in keys.items()], F.lit(side).alias("__side"), inner.alias("__row")))
    united = sides[0].unionByName(sides[1])
    one = lambda s: F.max(F.when(F.col("__side") == s, F.col("__row")))
    grouped = united.groupBy(*keys).agg(one(0).alias("__a"), one(1).alias("__b"))
    if lookup is not None:
        grouped = grouped.join(lookup[0], lookup[1], "left")
    at = {c: f"o{order.index(c)}_{c}" if order.count(c) == 1 else f"o{len(order) - 1 - order[::-1].index(c)}_{c}" for c in columns}

    def entry(name: str, va: Column, vb: Column) -> Column:
        return F.struct(F.lit(name).alias("difference"), va.cast("string").alias("value_a"), vb.cast("string").alias("value_b"))

    nothing = F.lit(None).cast("string")
    tests = []
    for r in rules:
        va, vb = F.col("__a")[at[r.column]], F.col("__b")[at[r.column]]
        tests.append(F.when(differs(va, vb, r), entry(r.column, va, vb)))
    both = F.filter(F.array(*tests), lambda x: x.isNotNull())
    found = (
        F.when(F.col("__b").isNull(), F.array(entry(f"only_{names[0]}", nothing, nothing)))
        .when(F.col("__a").isNull(), F.array(entry(f"only_{names[1]}", nothing, nothing)))
        .otherwise(both)
    )
    return grouped.select(*keys, F.explode(found).alias("__d")).select(*keys, "__d.*", F.lit(False).alias("match"))
