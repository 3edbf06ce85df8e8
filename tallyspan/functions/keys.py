"""Canonical forms of identifiers that arrive in several spellings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def coded_id(c: Column, prefix: str, digits: int) -> Column:
    """``PREFIX-000123`` from any spelling with the same letters and digits; null where it has none.

    Case, blanks, hyphens and underscores don't count. A number with fewer
    digits is padded; a text without digits gives null.
    """
    number = F.regexp_replace(c, r"[^0-9]", "")
    short = F.regexp_replace(number, r"^0+(?=[0-9])", "")
    plain = c.rlike(f"^{prefix}-[0-9]{{{digits}}}$")
    return F.when(plain, c).when(number != "", F.concat(F.lit(prefix + "-"), F.when(F.length(short) >= digits, short).otherwise(F.lpad(short, digits, "0"))))


def field_name(c: Column) -> Column:
    """snake_case field from spellings with other case, hyphens, blanks or outer blanks."""
    full = F.regexp_replace(F.lower(F.regexp_replace(c, r"(?U)^\s+|\s+$", "")), r"(?U)[\s\-_]+", "_")
    return F.when(c.rlike(r"^[a-z0-9]+(?:_[a-z0-9]+)*$"), c).otherwise(full)


def period_year(c: Column) -> Column:
    """Year of a quarter text, null where there is none."""
    return F.regexp_extract(c, r"(?<![0-9])([0-9]{4})(?![0-9])", 1).try_cast("int")


# Quarters by Roman or Arabic numeral.
_QUARTERS = {"I": 1, "II": 2, "III": 3, "IV": 4, "1": 1, "2": 2, "3": 3, "4": 4}


def period_quarter(c: Column) -> Column:
    """Quarter 1..4 of ``2024_Q2``, ``2024-QII``, ``IIQ2024``, ``Q2 2024``; null where there is none."""
    rest = F.upper(F.regexp_replace(c, r"(?<![0-9])[0-9]{4}(?![0-9])", " "))
    after = F.nullif(F.regexp_extract(rest, r"Q ?(IV|I{1,3}|[1-4])(?![A-Z0-9])", 1), F.lit(""))
    before = F.regexp_extract(rest, r"(?<![A-Z0-9])(IV|I{1,3}|[1-4]) ?Q", 1)
    table = F.create_map(*[F.lit(x) for p in _QUARTERS.items() for x in p])
    return F.try_element_at(table, F.coalesce(after, before))
