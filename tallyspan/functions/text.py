"""Text expressions that stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accented Latin letters and the plain letters they fold to.
ACCENTED = "áàâäãåéèêëíìîïóòôöõúùûüýÿñçÁÀÂÄÃÅÉÈÊËÍÌÎÏÓÒÔÖÕÚÙÛÜÝÑÇ"
PLAIN = "aaaaaaeeeeiiiiooooouuuuyyncAAAAAAEEEEIIIIOOOOOUUUUYNC"


def strip_accents(c: Column) -> Column:
    """Fold accented Latin letters; combining marks are dropped."""
    return F.regexp_replace(F.translate(c, ACCENTED, PLAIN), r"\p{M}", "")


def normalize_for_matching(c: Column) -> Column:
    """Lower case without accents; ``. , ; : ( ) [ ]`` become blanks; blanks collapse. Null stays null."""
    plain = F.lower(strip_accents(c))
    return F.trim(F.regexp_replace(F.regexp_replace(plain, r"[.,;:()\[\]]", " "), r"(?U)\s+", " "))


def clean_text(c: Column) -> Column:
    """Collapse white space and trim; null stays null."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def blank_to_null(c: Column) -> Column:
    """A text that is empty but for white space counts as missing."""
    trimmed = F.regexp_replace(c, r"(?U)^\s+|\s+$", "")
    return F.when(trimmed != "", trimmed)


def text_variants(c: Column) -> Column:
    """Lower-cased text, and the accent-free form where it differs."""
    low = F.lower(c)
    return F.array_distinct(F.array(low, strip_accents(low)))


def count_of(c: Column, part: Column) -> Column:
    """Occurrences of a one-character text."""
    return F.length(c) - F.length(F.replace(c, part, F.lit("")))


def content_hash(c: Column) -> Column:
    return F.sha2(c, 256)


def snake_case(c: Column) -> Column:
    """Header text as a snake_case name."""
    plain = F.lower(strip_accents(F.trim(c)))
    return F.regexp_replace(F.regexp_replace(plain, r"[^a-z0-9]+", "_"), r"^_+|_+$", "")


def format_sheet_name(c: Column) -> Column:
    """``snake_name`` as a title, with the acronyms EEFF and IFRS in capitals, cut to 31 characters."""
    title = F.initcap(F.replace(c, F.lit("_"), F.lit(" ")))
    for word in ("Eeff", "Ifrs"):
        title = F.regexp_replace(title, rf"\b{word}\b", word.upper())
    return F.substring(title, 1, 31)


def word_prefix(c: Column) -> Column:
    """First capitalised word of a CamelCase name, or an empty text."""
    return F.regexp_extract(c, r"[A-Z][a-z]*", 0)
