"""Number parsers as JVM expressions. The three parsers give different answers to one text on purpose."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyspan.functions.text import count_of

_TOKEN = r"-?[0-9.,]+"


def parse_thousands(c: Column) -> Column:
    """Whole number of a text in which points group thousands: ``1.234`` is 1234, and a comma is dropped, so ``1,5`` is 15.

    Parentheses anywhere make the result negative. Null, blank and texts that
    leave no integer give null.
    """
    kept = F.regexp_replace(c, r"[^0-9.\-]", "")
    number = F.replace(kept, F.lit("."), F.lit("")).try_cast("bigint")
    return F.when(c.contains("(") & c.contains(")"), -F.abs(number)).otherwise(number)


def parse_locale_decimal(c: Column) -> Column:
    """Struct ``(v double, is_int boolean)`` of a number with decimal comma: ``1.234`` is 1234, ``1.5`` is 1.5, ``1,5`` is 1.5.

    A single point before exactly three digits groups thousands. Only a
    leading hyphen makes it negative. Null where nothing can be read.
    """
    text = F.trim(c)
    kept = F.regexp_replace(F.regexp_replace(text, "^-", ""), r"[^0-9.,]", "")
    dots, comma = count_of(kept, F.lit(".")), kept.contains(",")
    whole = ~comma & ((dots == 0) | (dots > 1) | kept.rlike(r"^[^.]*\.[0-9]{3}$"))
    plain = F.when(comma, F.replace(F.replace(kept, F.lit("."), F.lit("")), F.lit(","), F.lit("."))).when(whole, F.replace(kept, F.lit("."), F.lit(""))).otherwise(kept)
    v = plain.try_cast("double")
    signed = F.when(text.startswith("-"), -v).otherwise(v)
    return F.when(v.isNotNull(), F.struct(signed.alias("v"), whole.alias("is_int")))


def parse_mixed_number(c: Column) -> Column:
    """Number of a text in either convention, told by the order and count of its marks; a lone point marks decimals.

    Currency marks and the letters C, L, P are dropped; outer parentheses make
    it negative. Null where nothing can be read.
    """
    text = F.trim(c)
    wrapped = text.startswith("(") & text.endswith(")") & (F.length(text) >= 2)
    inner = F.when(wrapped, F.substr(text, F.lit(2), F.length(text) - 2)).otherwise(text)
    kept = F.regexp_replace(inner, r"[$€£¥CLP\s]", "")
    dots, commas = count_of(kept, F.lit(".")), count_of(kept, F.lit(","))
    point_first = F.locate(".", kept) < F.locate(",", kept)
    plain = (
        F.when((dots > 1) | ((dots == 1) & (commas == 1) & point_first), F.replace(F.replace(kept, F.lit("."), F.lit("")), F.lit(","), F.lit(".")))
        .when((commas > 1) | ((commas == 1) & (dots == 1)), F.replace(kept, F.lit(","), F.lit("")))
        .otherwise(F.replace(kept, F.lit(","), F.lit(".")))
    )
    v = F.when(plain.rlike(r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"), plain.try_cast("double"))
    return F.when(wrapped, -v).otherwise(v)


def normalize_line(c: Column) -> Column:
    """Mend a text line's numbers: ``( 1.2 )`` to ``-1.2``, ``2 ,59`` to ``2,59``, a lone digit joined to the number after it.

    The last joins a one-digit note reference to the value too; see
    ``joins_lone_digit``.
    """
    negative = F.regexp_replace(c, r"\(\s*([0-9.,]+)\s*\)", "-$1")
    comma = F.regexp_replace(negative, r"([0-9])\s+,([0-9])", "$1,$2")
    return F.regexp_replace(comma, r"(?<=\s)([0-9])\s+([0-9])", "$1$2")


def joins_lone_digit(c: Column) -> Column:
    """Whether normalize_line joins a lone digit, which may have been a note reference."""
    return c.rlike(r"\s[0-9]\s+[0-9]")


def number_tokens(c: Column) -> Column:
    """All tokens of digits, points and commas that hold a digit, in order."""
    return F.filter(F.regexp_extract_all(c, F.lit(_TOKEN), F.lit(0)), lambda x: x.rlike("[0-9]"))


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it. For use inside lambdas, where Spark shares no subexpressions."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _token_value(token: Column) -> Column:
    """Struct ``(v, note)`` of a number token: parse_locale_decimal without what a token can't hold, and whether it looks like a note reference."""

    def read(k: Column) -> Column:
        dots, comma = count_of(k, F.lit(".")), k.contains(",")
        whole = ~comma & ((dots == 0) | (dots > 1) | (F.locate(".", k) == F.length(k) - 3))
        plain = F.when(comma, F.replace(F.replace(k, F.lit("."), F.lit("")), F.lit(","), F.lit("."))).when(whole, F.replace(k, F.lit("."), F.lit(""))).otherwise(k)
        return bound(F.struct(plain.try_cast("double").alias("v"), whole.alias("w")), lambda p: F.struct(F.when(token.startswith("-"), -p["v"]).otherwise(p["v"]).alias("v"), (p["w"] & ~token.startswith("-") & (p["v"] > 0) & (p["v"] < 100)).alias("note")))

    return bound(F.when(token.startswith("-"), F.substr(token, F.lit(2), F.length(token))).otherwise(token), read)


def line_values(c: Column) -> Column:
    """Array of parsed numbers of a line, without whole numbers of 1 to 99 that stand before the first value (note references)."""

    def from_first(marked: Column) -> Column:
        return bound(
            F.array_position(F.transform(marked, lambda p: p["note"]), F.lit(False)).cast("int"),
            lambda first: F.when(first > 0, F.transform(F.slice(marked, F.greatest(first, F.lit(1)), F.size(marked)), lambda p: p["v"])).otherwise(F.array().cast("array<double>")),
        )

    return bound(F.filter(F.transform(number_tokens(normalize_line(c)), _token_value), lambda p: p["v"].isNotNull()), from_first)


def current_value(c: Column, index: int = 0) -> Column:
    """The value in a column of a text line, or the first if the line has fewer; null without values."""
    return bound(line_values(c), lambda v: F.coalesce(F.get(v, F.lit(index)), F.get(v, F.lit(0))))


def scale_floor(c: Column, factor: int = 1000) -> Column:
    """Whole units after division, rounded down: -1500 gives -2."""
    return F.floor(c / F.lit(float(factor))).cast("bigint")


def scale_trunc(c: Column, factor: int = 1000) -> Column:
    """Whole units after division, rounded towards zero: -1500 gives -1."""
    return (c / F.lit(float(factor))).cast("bigint")
