"""Frame clean-up, document splits, availability of files, combined vectors, excluded pairs and report lines."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tallyspan.functions import periods
from tallyspan.functions.numbers import parse_mixed_number
from tallyspan.functions.text import ACCENTED, PLAIN
from tallyspan.functions.vectors import concat_unit
from tallyspan.operators.select import pick_first
from tallyspan.sources.tables import as_literal

_FOLD = str.maketrans(ACCENTED, PLAIN)


def column_name(header: str) -> str:
    """snake_case name of a header; ``column`` where nothing is left."""
    return re.sub(r"[^a-z0-9]+", "_", header.translate(_FOLD).lower()).strip("_") or "column"


def normalize_frame(df: DataFrame, dates: Sequence[str] = (), numbers: Sequence[str] = (), date_format: str | None = None) -> DataFrame:
    """Columns renamed to snake_case (clashing names numbered), the named ones read as time stamps or numbers; what can't be read becomes null. Names in ``dates`` and ``numbers`` may be old or new."""
    taken: dict[str, int] = {}
    out = []
    for i, c in enumerate(df.columns):
        name = column_name(c)
        taken[name] = taken.get(name, 0) + 1
        new = name if taken[name] == 1 else f"{name}_{taken[name]}"
        e = F.col(f"`__{i}`")
        if c in dates or new in dates:
            e = F.try_to_timestamp(e.cast("string"), F.lit(date_format)) if date_format else F.try_to_timestamp(e.cast("string"))
        elif c in numbers or new in numbers:
            e = parse_mixed_number(e.cast("string"))
        out.append(e.alias(new))
    return df.toDF(*[f"__{i}" for i in range(len(df.columns))]).select(*out)


def period_paths(base: str, year: Column, quarter: Column) -> Column:
    """Struct of the raw, processed, output and audit folders of a period."""
    key = periods.format_period(year, quarter)
    raw = lambda kind: F.concat_ws("/", F.lit(base), F.lit(kind), year.cast("string"), F.concat(F.lit("Q"), quarter.cast("string")))
    return F.struct(raw("raw").alias("raw"), F.concat(F.lit(f"{base}/processed/"), key).alias("processed"), F.concat(F.lit(f"{base}/output/"), year.cast("string")).alias("output"), F.concat(F.lit(f"{base}/audit/"), key).alias("audit"))


def availability(keys: DataFrame, listing: DataFrame, patterns: Mapping[str, Sequence[str]], key: Sequence[str]) -> DataFrame:
    """``keys`` with one column per document type: the first file of its name templates, in their order, that the listing holds; null where none.

    ``listing``: key columns and ``file``; templates are SQL LIKE patterns.
    """
    out = keys
    for kind, likes in patterns.items():
        rank = F.coalesce(*[F.when(F.col("file").like(p), F.lit(n)) for n, p in enumerate(likes)])
        first = pick_first(listing.withColumn("__rank", rank).where("__rank is not null"), key, [F.col("__rank"), F.col("file")], ["file"])
        out = out.join(first.withColumnRenamed("file", kind), list(key), "left")
    return out


def data_url(content: Column, mime: Column | str) -> Column:
    """Base64 data address of binary content; null stays null."""
    m = F.lit(mime) if isinstance(mime, str) else mime
    return F.concat(F.lit("data:"), m, F.lit(";base64,"), F.base64(content))


def split_document(pages: DataFrame, doc: Sequence[str], page: str, title: Column) -> DataFrame:
    """Pages with ``part``: 1 before a document's first title page, 2 from it on; all 1 where there is none. A null document is one of its own. ``title`` is a condition over a page."""
    first = pages.where(F.coalesce(title, F.lit(False))).groupBy(*[F.col(d).alias(f"__d{i}") for i, d in enumerate(doc)]).agg(F.min(page).alias("__first"))
    same = reduce(lambda x, y: x & y, [F.col(d).eqNullSafe(F.col(f"__d{i}")) for i, d in enumerate(doc)])
    return pages.join(first, same, "left").select(*pages.columns, F.when(F.col(page) >= F.col("__first"), 2).otherwise(1).alias("part"))


def combine_vectors(tables: Sequence[DataFrame], key: str, vector: str) -> DataFrame:
    """The vectors of a key from every table laid end to end and scaled to norm 1; keys that a table lacks are left out."""
    joined = tables[0].select(key, F.col(vector).alias("__v0"))
    for i, t in enumerate(tables[1:], 1):
        joined = joined.join(t.select(key, F.col(vector).alias(f"__v{i}")), key)
    return joined.select(key, concat_unit(*[F.col(f"__v{i}") for i in range(len(tables))]).alias(vector))


def exclude_pairs(pairs: DataFrame, a: str, b: str, patterns: DataFrame) -> DataFrame:
    """Pairs whose two names don't hold the two patterns of any row of a rule table ``(first, second)``, either way round."""
    rules = as_literal(patterns.select("first", "second"))
    x, y = F.col(a), F.col(b)
    return pairs.where(~F.exists(rules, lambda r: (x.contains(r["first"]) & y.contains(r["second"])) | (x.contains(r["second"]) & y.contains(r["first"]))))


def check_line(name: Column) -> Column:
    """One line of text for a check ``(expected, actual, difference, match)``."""
    # a zero is added, as a small negative figure would be shown as -0
    number = lambda c: F.coalesce(F.format_number(F.bround(F.col(c).cast("double"), 0) + F.lit(0.0), 0), F.lit("-"))
    return F.when(F.col("match"), F.concat(F.lit("ok: "), name, F.lit(" = "), number("actual"))).otherwise(
        F.concat(F.lit("mismatch: "), name, F.lit(" expected "), number("expected"), F.lit(", found "), number("actual"), F.lit(", off by "), number("difference"))
    )


def report_rows(checks: DataFrame, category: str, name: str) -> DataFrame:
    """``(category, line)``: one line of text per check. Rows rather than one text, so that a report may be as long as the checks are many."""
    return checks.select(F.col(category).alias("category"), check_line(F.col(name)).alias("line"))


def sectioned_report(checks: DataFrame, key: Sequence[str], category: str, rule: str, categories: Sequence[str]) -> DataFrame:
    """``(key, part, line_no, line)``: the report of each key: a header per category with its counts, ``not run`` where it has no check; a line per failed check; and a verdict at the end.

    Counts come from one aggregation per key and category. The lines of failed
    checks are rows of their own, numbered by rule name within their part.
    """
    counts = checks.groupBy(*key).agg(*[F.count_if((F.col(category) == c) & ok).alias(f"__{i}{n}") for i, c in enumerate(categories) for n, ok in (("p", F.col("match")), ("f", ~F.col("match")))])
    whole = F.lit(0)
    heads = []
    for i, c in enumerate(categories):
        passed, failed = F.col(f"__{i}p"), F.col(f"__{i}f")
        whole = whole + failed
        told = F.when(passed + failed == 0, F.lit("not run")).otherwise(F.concat(passed.cast("string"), F.lit(" passed, "), failed.cast("string"), F.lit(" failed")))
        heads.append(F.struct(F.lit(i).alias("part"), F.concat(F.lit(f"{c}: "), told).alias("line")))
    verdict = F.struct(F.lit(len(categories)).alias("part"), F.when(whole == 0, F.lit("all checks passed")).otherwise(F.concat(whole.cast("string"), F.lit(" checks failed"))).alias("line"))
    headers = counts.select(*key, F.inline(F.array(*heads, verdict))).select(*key, "part", F.lit(0).alias("line_no"), "line")
    part = F.array_position(F.array(*[F.lit(c) for c in categories]), F.col(category)).cast("int") - 1
    failed = checks.where(~F.col("match")).withColumns({"part": part, "__line": check_line(F.col(rule))})
    numbered = failed.withColumn("line_no", F.row_number().over(W.partitionBy(*key, "part").orderBy(rule, "__line")))
    return headers.unionByName(numbered.select(*key, "part", "line_no", F.col("__line").alias("line")))
