"""Period keys and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Roman numerals of the quarters.
ROMAN = ("I", "II", "III", "IV")


def quarter_to_roman(q: Column) -> Column:
    """1..4 to I..IV; anything else to null."""
    return F.get(F.array(*[F.lit(r) for r in ROMAN]), q.cast("int") - 1)


def roman_to_quarter(r: Column) -> Column:
    """I..IV in any case to 1..4; anything else to null."""
    at = F.array_position(F.array(*[F.lit(x) for x in ROMAN]), F.upper(F.trim(r))).cast("int")
    return F.when(at > 0, at)


def format_period(year: Column, period: Column, kind: Column | str = "quarterly", style: str = "key") -> Column:
    """Key ``2024_QII``, ``2024_M06``, ``2024_FY``; display ``IIQ2024``, ``06-2024``, ``FY2024``; another kind gives ``2024_Q2``."""
    k = F.lit(kind) if isinstance(kind, str) else kind
    y, p, roman = year.cast("string"), period.cast("string"), quarter_to_roman(period)
    month = F.lpad(p, 2, "0")
    if style == "display":
        return F.when(k == "quarterly", F.concat(roman, F.lit("Q"), y)).when(k == "monthly", F.concat_ws("-", month, y)).when(k == "yearly", F.concat(F.lit("FY"), y)).otherwise(F.concat(y, F.lit("_Q"), p))
    return F.when(k == "quarterly", F.concat(y, F.lit("_Q"), roman)).when(k == "monthly", F.concat(y, F.lit("_M"), month)).when(k == "yearly", F.concat(y, F.lit("_FY"))).otherwise(F.concat(y, F.lit("_Q"), p))


def parse_period(c: Column) -> Column:
    """Struct ``(year, period, kind)`` of a key with Roman or Arabic quarter, month or full year; null where it is none. The whole text must match."""
    year = F.regexp_extract(c, r"^([0-9]{4})_", 1).try_cast("int")
    numeral = F.nullif(F.regexp_extract(c, r"^[0-9]{4}_Q(IV|I{1,3}|[1-4])$", 1), F.lit(""))
    month = F.regexp_extract(c, r"^[0-9]{4}_M(0[1-9]|1[0-2])$", 1).try_cast("int")
    quarter = F.coalesce(roman_to_quarter(numeral), numeral.try_cast("int"))
    made = lambda p, k: F.struct(year.alias("year"), p.cast("int").alias("period"), F.lit(k).alias("kind"))
    return F.when(numeral.isNotNull(), made(quarter, "quarterly")).when(month.isNotNull(), made(month, "monthly")).when(c.rlike(r"^[0-9]{4}_FY$"), made(F.lit(1), "yearly"))


def period_sort_key(c: Column) -> Column:
    """Struct to sort period keys by; texts that are no keys come last."""
    p = parse_period(c)
    return F.struct(F.coalesce(p["year"], F.lit(9999)).alias("year"), F.coalesce(p["period"], F.lit(9)).alias("period"))


def quarter_end(year: Column, quarter: Column) -> Column:
    """ISO text of a quarter's last day."""
    end = F.get(F.array(F.lit("-03-31"), F.lit("-06-30"), F.lit("-09-30"), F.lit("-12-31")), quarter.cast("int") - 1)
    return F.concat(year.cast("string"), end)


def file_name(template: Column | str, year: Column, quarter: Column | None = None, period: Column | None = None) -> Column:
    """Fill ``{year}``, ``{quarter}``, ``{period}`` and ``{roman}`` in a template; the quarter wins over the period, 1 by default."""
    t = F.lit(template) if isinstance(template, str) else template
    p = F.coalesce(*[c for c in (quarter, period) if c is not None], F.lit(1))
    for mark, value in (("{year}", year), ("{quarter}", p), ("{period}", p), ("{roman}", quarter_to_roman(p))):
        t = F.replace(t, F.lit(mark), value.cast("string"))
    return t
