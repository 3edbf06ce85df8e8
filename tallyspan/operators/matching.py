"""Text matching: pages by tokens, labels, keywords, tables by score.

Rule lists are literals or small broadcast tables; the rows matched against
them are scanned once, with the rules folded into array expressions, so that
no rule x row join is materialised.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspan.functions.text import ACCENTED, PLAIN, normalize_for_matching
from tallyspan.operators.select import pick_first
from tallyspan.sources.tables import rule_rows

_FOLD = str.maketrans(ACCENTED, PLAIN)


def _texts(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def count_tokens(text: Column, tokens: Sequence[str]) -> Column:
    """How many of the tokens, with their accent-free variants, occur in a lower-cased text."""
    low = F.lower(text)
    both = F.array_distinct(F.flatten(F.array(F.transform(_texts(tokens), lambda t: F.lower(t)), F.transform(_texts(tokens), lambda t: normalize_for_matching(t)))))
    return F.size(F.filter(both, lambda t: low.contains(t)))


def page_matches(text: Column, required: Sequence[str], optional: Sequence[str] = (), min_required: int = 1, min_optional: int = 0) -> Column:
    return (count_tokens(text, required) >= min_required) & (count_tokens(text, optional) >= min_optional)


def find_page(pages: DataFrame, doc: Sequence[str], page: str, text: str, required: Sequence[str], optional: Sequence[str] = (), min_required: int = 1, min_optional: int = 0) -> DataFrame:
    """First page of each document that has enough of the required and optional tokens."""
    hit = page_matches(F.col(text), required, optional, min_required, min_optional)
    return pages.where(F.coalesce(hit, F.lit(False))).groupBy(*doc).agg(F.min(page).alias(page))


def section_context(text: Column, pattern: Column | str, before: int = 100, after: int = 200) -> Column:
    """Struct ``(position, context)`` of the first occurrence of a pattern, case aside, with the text around it; null where there is none."""
    p = F.lit(pattern) if isinstance(pattern, str) else pattern
    at = F.locate(pattern.lower(), F.lower(text)) if isinstance(pattern, str) else F.instr(F.lower(text), F.lower(p))
    start = F.greatest(F.lit(1), at - before)
    return F.when(at > 0, F.struct(at.alias("position"), F.substr(text, start, at + after - start).alias("context")))


def normalized(text: str) -> str:
    """normalize_for_matching of a text known on the driver."""
    plain = "".join(c for c in unicodedata.normalize("NFD", text.translate(_FOLD)).lower() if not unicodedata.combining(c))
    return re.sub(r"\s+", " ", re.sub(r"[.,;:()\[\]]", " ", plain)).strip()


def match_label(concept: Column, labels: Sequence[str]) -> Column:
    """The expected label a concept means: the longest that is contained in it, or of whose words four fifths occur in its words. Ties keep list order; null if none.

    Labels are normalised here, so the expression only tests for parts; a word
    without blanks occurs in the text where it occurs in one of its words.
    """
    return _match_normalized(normalize_for_matching(concept), labels)


def _match_normalized(own: Column, labels: Sequence[str]) -> Column:
    tests = []
    for label in sorted(labels, key=lambda x: -len(x)):
        n = normalized(label)
        words = n.split()
        shared = reduce(lambda x, y: x + y, [own.contains(w).cast("int") for w in words], F.lit(0))
        tests.append(F.when(own.contains(n) | (F.lit(bool(words)) & (shared >= len(words) * 0.8)), F.lit(label)))
    return F.coalesce(*tests, F.lit(None).cast("string"))


def of_section(section: Column, matched: Mapping[str, Column]) -> Column:
    """What the rules of a row's own section match, ``matched`` by section; null in sections without rules."""
    return F.coalesce(*[F.when(section == s, m) for s, m in matched.items()], F.lit(None).cast("string"))


def with_section_label(rows: DataFrame, concept: Column, section: str, labels: Mapping[str, Sequence[str]], name: str) -> DataFrame:
    """Rows with the label of their own section that a concept means, as match_label finds it; all sections in one scan."""
    # a column of its own, as a text normalised inside the section's branch would be normalised for each label
    own = rows.withColumn("__own", normalize_for_matching(concept))
    return own.withColumn(name, of_section(F.col(section), {s: _match_normalized(F.col("__own"), x) for s, x in labels.items()})).drop("__own")


def match_label_or_total(concept: Column, labels: Sequence[str], total: str = "Totales") -> Column:
    return F.coalesce(match_label(concept, labels), F.when(F.lower(concept).contains("total"), F.lit(total)))


def _holds(low: Column, words: Sequence[str] | None) -> Column:
    """Whether a lower-cased text holds one of the words."""
    return reduce(lambda x, y: x | y, [low.contains(w.lower()) for w in words or ()], F.lit(False))


def match_keywords(text: Column, rules: Sequence[tuple[str, Sequence[str], Sequence[str]]]) -> Column:
    """The first field (in list order) of whose match words one occurs and of whose exclude words none does; null if none."""
    low = F.lower(text)
    return F.coalesce(*[F.when(_holds(low, match) & ~_holds(low, exclude), F.lit(field)) for field, match, exclude in rules], F.lit(None).cast("string"))


def keyword_values(lines: DataFrame, key: Sequence[str], line_no: str, text: str, value: Column, rules: DataFrame) -> DataFrame:
    """Per document and field, the value of the first line that holds a keyword of the field, no excluded one, and a value.

    ``rules``: field, match_words, exclude_words, a rule table. Each line is
    matched with all rules inside one expression; only lines that match are
    parsed for a value.
    """
    # a column of its own, as inside the rules' branches the text would be lowered for each of them
    low, lines = F.col("__low"), lines.withColumn("__low", F.lower(F.col(text)))
    meant = F.array_compact(F.array(*[F.when(_holds(low, r.match_words) & ~_holds(low, r.exclude_words), F.lit(r.field)) for r in rule_rows(rules)]).cast("array<string>"))
    matched = lines.select(*key, line_no, text, F.explode(meant).alias("field"))
    # exploded rather than filtered, as a filter would be pushed down and evaluate the value twice
    valued = matched.select(*key, "field", line_no, F.explode(F.array_compact(F.array(value))).alias("value"))
    return pick_first(valued, [*key, "field"], [F.col(line_no)], ["value"])


def table_text(cells: Column) -> Column:
    """Text of a row of cells for scoring: lower case, cells apart, line breaks marked."""
    return F.lower(F.replace(F.concat_ws("', '", cells), F.lit("\n"), F.lit("\\n")))


def score_table(text: Column, expected: Sequence[str], unique: Sequence[str] = (), exclude: Sequence[str] = ()) -> Column:
    """+1 for each expected item in a lower-cased text, 5 more for each unique and less for each excluded one, and again for its normalised form if that differs and occurs too."""
    score = F.lit(0)
    for item in expected:
        score = score + text.contains(item.lower()).cast("int")
    for items, weight in ((unique, 5), (exclude, -5)):
        for item in items:
            form = normalize_for_matching(F.lit(item))
            score = score + text.contains(item.lower()).cast("int") * weight + ((form != item.lower()) & text.contains(form)).cast("int") * weight
    return score


def best_table(tables: DataFrame, key: Sequence[str], index: str, text: str, expected: Sequence[str], unique: Sequence[str] = (), exclude: Sequence[str] = (), least: int = 3) -> DataFrame:
    """The table of greatest score per key, the first among equals, if it reaches ``least``."""
    scored = tables.withColumn("score", score_table(F.col(text), expected, unique, exclude)).where(F.col("score") >= least)
    return pick_first(scored, key, [-F.col("score"), F.col(index)], [index, "score"])


def best_table_or_next(tables: DataFrame, wanted: DataFrame, key: Sequence[str], page: str, index: str, text: str, expected: Sequence[str], unique: Sequence[str] = (), exclude: Sequence[str] = (), least: int = 3) -> DataFrame:
    """``(key, page, index, score)``: the best table on the wanted page of each key, or where none there reaches ``least``, on the page after it.

    ``wanted``: key and page. An equi-join on key and page, not on the key
    alone, so that only the tables of the two pages are scored.
    """
    turns = wanted.select(*key, F.posexplode(F.array(F.col(page), F.col(page) + 1)).alias("__turn", page))
    scored = tables.join(turns, [*key, page]).withColumn("score", score_table(F.col(text), expected, unique, exclude)).where(F.col("score") >= least)
    return pick_first(scored, key, [F.col("__turn"), -F.col("score"), F.col(index)], [page, index, "score"])
