"""Rows of table grids: ``(doc, page, table_idx, row_idx, cells array<string>)`` to labels with values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tallyspan.functions.numbers import parse_thousands
from tallyspan.operators.matching import match_label_or_total, with_section_label


def value_columns(cells: Column) -> Column:
    """Value cells (all but the first) split at line breaks; an empty or null cell is an empty list."""
    return F.transform(F.slice(cells, 2, F.greatest(F.lit(1), F.size(cells))), lambda c: F.when(F.coalesce(F.trim(c), F.lit("")) != "", F.split(F.trim(c), "\n")).otherwise(F.array().cast("array<string>")))


def values_at(columns: Column, index: Column, compact: bool = False) -> Column:
    """Parsed values of each value column at one line. ``compact`` drops what can't be parsed, so that later values move left."""
    parsed = F.transform(columns, lambda c: parse_thousands(F.get(c, index)))
    return F.filter(parsed, lambda v: v.isNotNull()) if compact else parsed


def parse_grid(rows: DataFrame, key: Sequence[str], row: str, cells: str, labels: Sequence[str] | Mapping[str, Sequence[str]], compact: bool = False, section: str | None = None) -> DataFrame:
    """``(key, row, line, concepto, values)``: a label cell with k lines gives k rows. Rows whose label matches none of ``labels`` or no total are dropped, as are blank rows.

    ``section``: a column of ``key``; ``labels`` are then by section, and a row is matched with those of its own.
    """
    lines = rows.select(*key, row, F.col(cells).alias("__cells"), F.posexplode(F.split(F.coalesce(F.get(cells, F.lit(0)), F.lit("")), "\n")).alias("line", "__text"))
    there = lines.where(F.trim("__text") != "")
    if section is None:
        named = there.withColumn("concepto", match_label_or_total(F.col("__text"), labels)).where("concepto is not null")
    else:
        labelled = with_section_label(there, F.col("__text"), section, labels, "__label")
        meant = F.coalesce("__label", match_label_or_total(F.col("__text"), []))
        # exploded rather than filtered, as a filter would be pushed down and match the labels again
        named = labelled.select(*key, row, "__cells", "line", F.explode(F.array_compact(F.array(meant))).alias("concepto"))
    return named.select(*key, row, "line", "concepto", values_at(value_columns(F.col("__cells")), F.col("line"), compact).alias("values"))


def line_items(parsed: DataFrame, key: Sequence[str]) -> DataFrame:
    """Parsed rows with named figures: the first four values in order."""
    names = ("ytd_actual", "ytd_anterior", "quarter_actual", "quarter_anterior")
    return parsed.select(*key, "concepto", *[F.get("values", F.lit(i)).alias(n) for i, n in enumerate(names)])


def label_index(labels: Column, keywords: Sequence[str]) -> Column:
    """0-based place of the first label that holds all keywords, case aside; null if none."""
    low = F.transform(labels, lambda x: F.lower(x))
    words = F.array(*[F.lit(k.lower()) for k in keywords]).cast("array<string>")
    at = F.array_position(F.transform(low, lambda x: F.forall(words, lambda k: x.contains(k))), F.lit(True)).cast("int")
    return F.when(at > 0, at - 1)


def value_offset(labels: Column, index: Column) -> Column:
    """How many labels before a place end in a word with a digit, and so take a value of their own."""
    earlier = F.slice(labels, 1, F.coalesce(index, F.lit(0)))
    return F.size(F.filter(earlier, lambda x: F.element_at(F.split(F.trim(x), r"\s+"), -1).rlike("[0-9]")))


def value_from_row(cells: Column, keywords: Sequence[str], least: int = 0) -> Column:
    """The value of the label line with all keywords: the one aligned with it if above ``least``, else the row's first value above it; null if the label cell lacks the keywords."""
    labels = F.split(F.coalesce(F.get(cells, F.lit(0)), F.lit("")), "\n")
    at = label_index(labels, keywords)
    values = F.transform(F.flatten(value_columns(cells)), lambda v: parse_thousands(v))
    whole = F.forall(F.array(*[F.lit(k.lower()) for k in keywords]), lambda k: F.lower(F.get(cells, F.lit(0))).contains(k))
    aligned = F.get(values, value_offset(labels, at))
    first = F.get(F.filter(values, lambda v: v > least), F.lit(0))
    return F.when(whole, F.coalesce(F.when(at.isNotNull() & (aligned > least), aligned), first))


def markdown_tables(pages: DataFrame, key: Sequence[str], text: str, least: int = 2) -> DataFrame:
    """``(key, table_idx, row_idx, cells)`` of pipe tables in texts: runs of lines with a pipe, of ``least`` lines or more; separator rows are dropped, the first row is the header.

    Runs are found with a running count of interruptions over a document's
    own lines, an array expression within the row, so there is no shuffle.
    """
    lines = F.transform(F.split(F.col(text), r"\r?\n"), lambda x: F.trim(x))
    marked = F.aggregate(
        lines,
        F.struct(F.lit(0).alias("run"), F.array().cast("array<struct<run:int,line:string>>").alias("rows")),
        lambda acc, x: F.when(x.contains("|"), F.struct(acc["run"].alias("run"), F.concat(acc["rows"], F.array(F.struct(acc["run"].alias("run"), x.alias("line")))).alias("rows"))).otherwise(
            F.struct((acc["run"] + 1).alias("run"), acc["rows"].alias("rows"))
        ),
    )
    rows = pages.select(*key, F.posexplode(marked["rows"]).alias("__pos", "__r")).select(*key, "__pos", F.col("__r.run").alias("__run"), F.regexp_replace("__r.line", r"^\||\|$", "").alias("__line"))
    runs = W.partitionBy(*key, "__run")
    sized = rows.withColumn("__n", F.count("*").over(runs)).where((F.col("__n") >= least) & ~F.col("__line").rlike(r"^[\s:|\-]+$"))
    return sized.select(
        *key,
        (F.dense_rank().over(W.partitionBy(*key).orderBy("__run")) - 1).alias("table_idx"),
        (F.row_number().over(runs.orderBy("__pos")) - 1).alias("row_idx"),
        F.transform(F.split("__line", r"\|"), lambda c: F.trim(c)).alias("cells"),
    )
