"""Queries of text matching, segments, filings, sheets, vectors and streaming over the driver's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan.functions import vectors
from tallyspan.functions.numbers import current_value
from tallyspan.operators import filings, grids, matching, segments, similarity
from tallyspan.operators.select import pick_first
from tallyspan.plans import sheets
from tallyspan.sources import filings as sources
from tallyspan.sources.tables import rule_rows, table
from tallyspan.streaming import ingest


def _by_section(spark: SparkSession, sf_dir: str) -> dict[str, list]:
    """The keyword rules of each section in their order."""
    rules: dict[str, list] = {}
    for r in sorted(rule_rows(table(spark, sf_dir, "keyword_rule")), key=lambda r: (r.section, r.rule_ord)):
        rules.setdefault(r.section, []).append(r)
    return rules


def _section_labels(spark: SparkSession, sf_dir: str) -> dict[str, list[str]]:
    return {s: [x for r in rules for x in r.labels or ()] for s, rules in _by_section(spark, sf_dir).items()}


def _section_field(spark: SparkSession, sf_dir: str) -> Column:
    """The field that an item's concept means by the keywords of the item's own section."""
    rules = {s: [(r.field, r.match_words, r.exclude_words) for r in rs] for s, rs in _by_section(spark, sf_dir).items()}
    return matching.of_section(F.col("section"), {s: matching.match_keywords(F.col("concepto"), rs) for s, rs in rules.items()})


def label_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items by the longest contained label of their section, or four fifths of its words."""
    items = table(spark, sf_dir, "line_item").select("item_id", "section", "concepto")
    return matching.with_section_label(items, F.col("concepto"), "section", _section_labels(spark, sf_dir), "label").select("item_id", "label")


def keyword_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items by the first field of their section whose keywords occur and whose excluded words don't."""
    return table(spark, sf_dir, "line_item").select("item_id", _section_field(spark, sf_dir).alias("field"))


def page_find(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First page of each segment's documents that speaks of cost and of energy or debt."""
    pages = table(spark, sf_dir, "documents").select("segment_id", "page_no", "text")
    return matching.find_page(pages, ["segment_id"], "page_no", "text", ["costo", "cost", "coût"], ["energía", "deuda", "debt", "power"], 1, 1)


def section_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "documents").select("doc_id", matching.section_context(F.col("text"), "nota ").alias("s")).where("s is not null")
    return found.select("doc_id", "s.position", F.md5("s.context").alias("context_md5"))


_EXPECTED = ("costo", "margen", "flujo", "deuda", "cobre")
_UNIQUE, _EXCLUDED = ("dotación",), ("auditores",)


def table_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", matching.score_table(F.lower("text"), _EXPECTED, _UNIQUE, _EXCLUDED).alias("score")).where("score is not null")


def best_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best scored document of each segment; documents without one are a group of their own."""
    docs = table(spark, sf_dir, "documents").select("segment_id", "doc_id", F.lower("text").alias("t")).where("t is not null")
    return matching.best_table(docs, ["segment_id"], "doc_id", "t", _EXPECTED, _UNIQUE, _EXCLUDED, 2)


def explode_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = segments.text_lines(table(spark, sf_dir, "documents"), ["doc_id"], "text")
    return lines.select("doc_id", "line_no", F.length("line").alias("n_chars"))


def line_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The value of the first line of each document that names a field and has a value; a field that two sections have comes out once for each."""
    lines = segments.text_lines(table(spark, sf_dir, "documents"), ["doc_id"], "text")
    rules = table(spark, sf_dir, "keyword_rule").select(F.concat_ws("/", "section", "field").alias("field"), "match_words", "exclude_words")
    found = matching.keyword_values(lines, ["doc_id"], "line_no", "line", current_value(F.col("line")), rules)
    part = lambda n: F.split_part("field", F.lit("/"), F.lit(n))
    return found.select("doc_id", part(1).alias("section"), part(2).alias("field"), "value")


def line_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of a user between a signup and the next error or signup."""
    rows = segments.segment_rows(table(spark, sf_dir, "events"), ["user_id"], ["event_id"], F.col("event_type") == "signup", F.col("event_type") == "error", F.floor(F.col("event_id") / 10_000))
    return rows.groupBy("user_id", "seg_no").agg(F.count("*").alias("n"), F.min("event_id").alias("first_id"))


def chosen_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's first segment with a large purchase, else the longest of three or more."""
    rows = segments.segment_rows(table(spark, sf_dir, "events"), ["user_id"], ["event_id"], F.col("event_type") == "signup", F.col("event_type") == "error", F.floor(F.col("event_id") / 10_000))
    return segments.choose_segment(rows, ["user_id"], (F.col("event_type") == "purchase") & (F.col("value") > 60), 3)


def latest_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filings.latest_context(table(spark, sf_dir, "xbrl_context"))


def _current(spark: SparkSession, sf_dir: str) -> DataFrame:
    year, quarter = F.regexp_extract("doc_id", r"_([0-9]{4})Q", 1).try_cast("int"), F.regexp_extract("doc_id", r"Q([1-4])$", 1).try_cast("int")
    return filings.chosen_context(table(spark, sf_dir, "xbrl_context"), year, quarter)


def current_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _current(spark, sf_dir)


def year_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    year = F.regexp_extract("doc_id", r"_([0-9]{4})Q", 1).try_cast("int")
    return filings.chosen_context(table(spark, sf_dir, "xbrl_context"), year, F.lit(4), yearly=True)


def fact_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts with their context."""
    return filings.with_contexts(table(spark, sf_dir, "xbrl_fact"), table(spark, sf_dir, "xbrl_context")).select("fact_id", "doc_id", "context_ref", "period_type", "start_date", "end_date", "instant")


def facts_by_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filings.facts_named(table(spark, sf_dir, "xbrl_fact"), "profitloss", exact=False).select("fact_id", "name")


def mapped_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All mapped fields of each filing: durations in its current context, instants in its yearly one."""
    year, quarter = F.regexp_extract("doc_id", r"_([0-9]{4})Q", 1).try_cast("int"), F.regexp_extract("doc_id", r"Q([1-4])$", 1).try_cast("int")
    return sheets.from_filings(table(spark, sf_dir, "xbrl_fact"), table(spark, sf_dir, "xbrl_context"), table(spark, sf_dir, "fact_mapping"), year, quarter)


def ytd_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greatest year-to-date value of every fact of each filing."""
    return filings.year_to_date_max(table(spark, sf_dir, "xbrl_fact"), table(spark, sf_dir, "xbrl_context"))


def fact_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filings.fact_categories(table(spark, sf_dir, "xbrl_fact"))


def units_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filings.units(table(spark, sf_dir, "xbrl_fact"))


def sheet_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sheet files with the sheet and quarter their name tells."""
    return sources.sheet_files(table(spark, sf_dir, "sheet_file").select("file_id", "file_name"), "file_name").select("file_id", "sheet_name", "year", "quarter")


def sheet_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sheet figures from items: matched by the keywords of their section, a later item overwriting an earlier one."""
    items = table(spark, sf_dir, "line_item").where("ytd_actual is not null")
    named = items.select("doc_id", "section", "item_ord", "item_id", "ytd_actual", _section_field(spark, sf_dir).alias("field")).where("field is not null")
    return pick_first(named, ["doc_id", "section", "field"], [-F.col("item_ord"), -F.col("item_id")], ["ytd_actual"])


def grid_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table rows of items rebuilt as cells and parsed by the labels of their section, a total row included."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("-"))
    cells = F.array("concepto", *[text(c) for c in ("ytd_actual", "ytd_anterior", "quarter_actual", "quarter_anterior")])
    rows = table(spark, sf_dir, "line_item").where("concepto is not null").select("doc_id", "section", "item_id", cells.alias("cells"))
    parsed = grids.parse_grid(rows, ["doc_id", "section"], "item_id", "cells", _section_labels(spark, sf_dir), section="section")
    return grids.line_items(parsed, ["doc_id", "section", "item_id", "line"])


def _queries(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = table(spark, sf_dir, "embeddings")
    return rows, rows.where("vec_id % 50 = 0")


def vector_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten nearest rows of each query row (those whose id is divisible by 50) among all."""
    found = similarity.top_k(*_queries(spark, sf_dir), 10)
    return found.select("query_id", "neighbor_id", "rank", F.round("similarity", 5).alias("similarity"))


def neighbor_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = similarity.neighbor_counts(*_queries(spark, sf_dir), 0.3)
    return found.select("query_id", "n", F.round("max_similarity", 5).alias("max_similarity"))


def similar_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row that is close to a query row, a pair of two queries once."""
    return similarity.similar_pairs(*_queries(spark, sf_dir), 0.3).select("query_id", "neighbor_id", F.round("similarity", 5).alias("similarity"))


def similarity_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report lines of pairs that are too close and of queries with several close neighbours."""
    return similarity.violations(similarity.similar_pairs(*_queries(spark, sf_dir), 0.3), 0.4).select("id", "kind", "n")


def concat_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector laid twice end to end and scaled to norm 1: its ends and their cosine with the vector itself."""
    e = F.col("embedding")
    rows = table(spark, sf_dir, "embeddings").select("vec_id", e, vectors.concat_unit(e, e).alias("c"))
    return rows.select("vec_id", F.size("c").alias("width"), F.round(F.get("c", F.lit(0)), 6).alias("first"), F.round(vectors.norm(F.col("c")), 6).alias("norm"), F.round(vectors.cosine(e, F.slice("c", 1, F.size(e))), 6).alias("same"))


def refactor_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weighted index of parts from two counts and a similarity share."""
    index = vectors.similarity_index((F.col("p_partkey") % 100) / 100)
    return table(spark, sf_dir, "part").select("p_partkey", F.round(vectors.refactor_index(F.col("p_size"), F.col("p_size") % 7, index), 6).alias("score"))


def pca_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two clusters of the embeddings after PCA. No SQL: k-means starts at random points."""
    reduced, k = similarity.pca(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), variance=0.9)
    return similarity.clusters(reduced.select("vec_id", "reduced")).select("vec_id", F.size("reduced").alias("components"), "cluster")


def stream_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per hour and kind, by a stream over what is there now."""
    shape = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    stream = spark.readStream.schema(shape).parquet(f"{sf_dir}/events.parque[t]")  # a glob, as the source takes a plain path for a folder
    events = stream.withColumn("ts", F.col("ts").cast("timestamp"))
    return ingest.drain(ingest.window_totals(events, "ts", ["event_type"], "value"), "totals", ["window_start", "event_type"]).withColumn("total", F.round("total", 2))


QUERIES = {
    f.__name__: f
    for f in (
        label_match, keyword_match, page_find, section_context, table_score, best_table, explode_lines, line_values, line_segments, chosen_segment, latest_context, current_context, year_context,
        fact_contexts, facts_by_substring, mapped_facts, ytd_max, fact_categories, units_distinct, sheet_listing, sheet_items, grid_rows, vector_topk, neighbor_counts, similar_pairs, similarity_violations, concat_normalize, refactor_index,
        pca_clusters, stream_totals,
    )
}
