"""The reference list of problem 3, labels and keywords of the rules, and the wordings that the data show to mean the same.

A wording is learnt as an alias of a field where figures tell: the same figure
of the same segment and quarter stands under the field's name in another table
(copies of the figures, tagged facts, provenance, KPI readings, sheet files).
One such hit may be chance, so a wording must meet its field in several
documents, meet it far more often than other fields, over all sections
together too, and carry a share of all the field's hits. No list of wordings
is kept by hand.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan.functions.keys import field_name, period_quarter, period_year
from tallyspan.llm.canonical import core, is_blank
from tallyspan.session import ship_package, written
from tallyspan.sources.tables import broadcast_if_small, rule_rows, table


@dataclass(frozen=True)
class Evidence:
    """What makes a wording an alias: documents in which its figure meets the field's, the share of the wording's hits that the field has (one more counted against it), and the wording's share of the field's hits.

    ``support`` bounds the aliases of a field to 1 / support.
    """

    documents: int = 2
    concentration: float = 0.6
    support: float = 0.01


def number_keys(c: Column) -> Column:
    """Significant digits of a number and of its whole thousandths: what two notations of one figure in different decimal scales share."""
    size = F.abs(c.cast("double"))
    digits = lambda x: F.btrim(F.replace(x.cast("string"), F.lit("."), F.lit("")), F.lit("0"))
    return _telling(F.array(digits(size.try_cast("decimal(30,6)")), digits(F.round(size * 1000).try_cast("decimal(30,0)"))))


def text_keys(c: Column) -> Column:
    """Significant digits of the first number of a text, and number_keys of a text that is a number."""
    digits = F.btrim(F.regexp_replace(F.regexp_extract(c, r"[0-9][0-9.,]*", 0), r"[^0-9]", ""), F.lit("0"))
    return F.array_union(_telling(F.array(digits)), F.coalesce(number_keys(c.try_cast("double")), F.array().cast("array<string>")))


def _telling(keys: Column) -> Column:
    return F.filter(keys, lambda k: F.length(k) >= 2)


def learn_aliases(items: DataFrame, evidence: DataFrame, fields: DataFrame, block: Sequence[str], needed: Evidence | None = None) -> DataFrame:
    """``(block, entry, target, hits)``: the core wordings that mean a field.

    ``items``: the block columns, ``text``, ``doc`` and ``keys``, hashes of the
    item's figures with their place; ``evidence``: ``field`` and ``key``, the
    same hashes; ``fields``: the block columns and ``field``, a rule table.
    Both sides are made distinct before they meet, so that neither repeated
    items nor repeated figures weigh more, and a key meets at most as many
    rows as there are fields. A written table.
    """
    need, block = needed or Evidence(), list(block)
    ship_package(items.sparkSession)
    asked = items.where("text is not null").select(*block, "text", "doc", F.explode("keys").alias("key")).distinct()
    known = evidence.select("field", "key").distinct()
    met = asked.join(known, "key").join(broadcast_if_small(fields.select(*block, "field").distinct()), [*block, "field"], "left_semi")
    hits = met.select(*block, "text", "field", "doc").distinct().groupBy(*block, "text", "field").agg(F.count("*").alias("n"))

    def cores(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(text=[core(t) for t in batch["text"]])

    of_core = hits.mapInPandas(cores, hits.schema).where("text <> ''").groupBy(*block, "text", "field").agg(F.sum("n").alias("n"))
    per = written(of_core, "alias-hits")
    tops = per.groupBy(*block, "text").agg(F.sum("n").alias("of_text"), F.max(F.struct("n", "field")).alias("best"))
    overall = tops.groupBy("text").agg(F.sum("of_text").alias("all_hits"), F.sum("best.n").alias("all_best"))
    of_field = per.groupBy(*block, "field").agg(F.sum("n").alias("of_field"))
    hits_of = F.col("best.n")
    clear = (hits_of >= need.documents) & (hits_of / (F.col("of_text") + 1) >= need.concentration)
    named = tops.where(clear).select(*block, "text", F.col("best.field").alias("field"), hits_of.alias("hits"))
    kept = named.join(broadcast_if_small(of_field), [*block, "field"]).where(F.col("hits") >= F.col("of_field") * need.support)
    kept = kept.join(overall, "text").where(F.col("all_best") / (F.col("all_hits") + 1) >= need.concentration)
    return written(kept.select(*block, F.col("text").alias("entry"), F.col("field").alias("target"), "hits"), "aliases")


def _place(segment: Column, year: Column, quarter: Column, digits: Column) -> Column:
    return F.xxhash64(segment, year.cast("int"), quarter.cast("int"), digits)


def _segment(c: Column) -> Column:
    return F.regexp_replace(c, r"[^0-9]+", "").try_cast("bigint")


_DOC_YEAR, _DOC_QUARTER = r"_([0-9]{4})Q[1-4]$", r"_[0-9]{4}Q([1-4])$"


def _of_doc(c: Column) -> tuple[Column, Column, Column]:
    return _segment(F.regexp_extract(c, r"^(.*?)_[0-9]{4}Q[1-4]$", 1)), F.regexp_extract(c, _DOC_YEAR, 1).try_cast("int"), F.regexp_extract(c, _DOC_QUARTER, 1).try_cast("int")


def figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(field, key)``: every figure that a table holds under a field's name, hashed with segment and quarter."""
    read = lambda name: table(spark, sf_dir, name)
    out = []
    for name in ("value_pdf", "value_xbrl", "kpi_value"):
        out.append(read(name).select(_segment(F.col("segment_id")).alias("s"), F.col("year").alias("y"), F.col("quarter").alias("q"), field_name(F.col("field")).alias("field"), number_keys(F.col("value")).alias("keys")))
    prov = read("provenance").where("raw_value is not null")
    out.append(prov.select(_segment(F.col("segment_id")).alias("s"), period_year(F.col("period")).alias("y"), period_quarter(F.col("period")).alias("q"), field_name(F.col("field")).alias("field"), text_keys(F.col("raw_value")).alias("keys")))
    mapped = [(n, m.field) for m in rule_rows(read("fact_mapping")) for n in (m.primary_fact, *(m.fallbacks or ()))]
    names = F.broadcast(spark.createDataFrame(mapped, "name string, field string").distinct())
    s, y, q = _of_doc(F.col("doc_id"))
    facts = read("xbrl_fact").where("value is not null").select(s.alias("s"), y.alias("y"), q.alias("q"), F.trim("name").alias("name"), "value").join(names, "name")
    out.append(facts.select("s", "y", "q", "field", text_keys(F.col("value")).alias("keys")))
    known = sorted({r.field for r in rule_rows(read("field_rule"))})
    flat = ", ".join(f"`{f}`: string" for f in known)
    file = F.regexp_replace("file_name", r"^[A-Za-z]+[0-9]+_|\.json$", "")
    parsed = read("sheet_file").select(_segment(F.col("segment_id")).alias("s"), period_year(file).alias("y"), period_quarter(file).alias("q"), F.from_json("content", f"struct<content: struct<{flat}>, {flat}>").alias("j"))
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.coalesce(F.col("j.content")[f], F.col("j")[f]).alias("v")) for f in known])
    out.append(parsed.select("s", "y", "q", F.inline(pairs)).where("v is not null").select("s", "y", "q", "field", text_keys(F.col("v")).alias("keys")))
    whole = reduce(DataFrame.unionByName, out).where("s is not null and y is not null and q is not null and field is not null")
    return whole.select("s", "y", "q", "field", F.explode("keys").alias("d")).select("field", _place(F.col("s"), F.col("y"), F.col("q"), F.col("d")).alias("key"))


def figured_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with the hashes of their year-to-date figures: this year's in its own quarter, last year's in the quarter a year before."""
    s, y, q = _of_doc(F.col("doc_id"))
    rows = table(spark, sf_dir, "line_item").where(~is_blank(F.col("concepto"))).select("sheet", "section", F.col("concepto").alias("text"), F.xxhash64("doc_id").alias("doc"), s.alias("s"), y.alias("y"), q.alias("q"), "ytd_actual", "ytd_anterior")
    hashes = lambda c, back: F.transform(number_keys(F.col(c)), lambda d: _place(F.col("s"), F.col("y") - back, F.col("q"), d))
    none = F.array().cast("array<bigint>")
    keys = F.concat(F.coalesce(hashes("ytd_actual", 0), none), F.coalesce(hashes("ytd_anterior", 1), none))
    return rows.where("s is not null and y is not null and q is not null").select("sheet", "section", "text", "doc", keys.alias("keys"))


def aliases(spark: SparkSession, sf_dir: str, needed: Evidence | None = None) -> DataFrame:
    """Wordings of line items learnt as aliases of the fields of their section."""
    fields = table(spark, sf_dir, "field_rule").select("sheet", "section", "field")
    return learn_aliases(figured_items(spark, sf_dir), figures(spark, sf_dir), fields, ["sheet", "section"], needed)


def rule_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(sheet, section, entry, target, order)``: the labels and keywords of the rules."""
    rows: dict[tuple[str, str, str, str], int] = {}
    for r in rule_rows(table(spark, sf_dir, "field_rule")):
        rows[r.sheet, r.section, r.label, r.field] = r.rule_ord
    for r in rule_rows(table(spark, sf_dir, "keyword_rule")):
        for entry in (*(r.labels or ()), *(r.match_words or ())):
            rows.setdefault((r.sheet, r.section, entry, r.field), r.rule_ord)
    return spark.createDataFrame([(*k, v) for k, v in sorted(rows.items())], "sheet string, section string, entry string, target string, order int")


def reference_entries(spark: SparkSession, sf_dir: str, learnt: DataFrame | None = None) -> DataFrame:
    """The entries of the rules and, after them in order, the learnt aliases (those of ``aliases`` unless given)."""
    more = aliases(spark, sf_dir) if learnt is None else learnt
    return rule_entries(spark, sf_dir).unionByName(more.select("sheet", "section", "entry", "target", F.lit(1_000_000).alias("order")))


def free_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items whose concepto is neither blank nor exactly a label of its sheet and section."""
    labels = [(r.sheet, r.section, r.label) for r in rule_rows(table(spark, sf_dir, "field_rule"))]
    exact = F.broadcast(spark.createDataFrame(labels, "sheet string, section string, concepto string"))
    items = table(spark, sf_dir, "line_item").select("item_id", "sheet", "section", "concepto").where(~is_blank(F.col("concepto")))
    return items.join(exact, ["sheet", "section", "concepto"], "left_anti")
