"""Queries of the llm subpackage with their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan.functions.keys import field_name, period_quarter, period_year
from tallyspan.llm import bpe, canonical, concepts, language, packing, survivors
from tallyspan.session import written
from tallyspan.sources.tables import table

_FIGURE = ("filer", "segment", "quarter", "fld")


def source_kind(c: Column) -> Column:
    """``xml``, ``text`` or ``ocr`` of a source type however spelled; null where it says none."""
    plain = F.lower(c)
    return F.when(plain.contains("ocr"), "ocr").when(plain.contains("xml") | plain.contains("xbrl"), "xml").when(plain.contains("pdf") | plain.contains("text"), "text")


def confidence_share(c: Column) -> Column:
    """Confidence in whole hundredths; values above 1 are percent; null for null and NaN."""
    known = F.when(~F.isnan(c), c)
    return F.round(F.when(known > 1, known).otherwise(known * 100)).cast("int")


def _figures(spark: SparkSession, sf_dir: str, texts: bool = False) -> DataFrame:
    """Records of provenance with unified keys as a written table of narrow columns, since learning and ranking both read it.

    Ids and periods become numbers, fields snake_case. ``texts`` keeps raw_value and location.
    """
    number = lambda c: F.regexp_replace(c, r"[^0-9]+", "").try_cast("bigint")
    rows = table(spark, sf_dir, "provenance").select(
        number("filer_id").alias("filer"), number("segment_id").alias("segment"), (period_year(F.col("period")) * 4 + period_quarter(F.col("period"))).alias("quarter"), field_name(F.col("field")).alias("fld"),
        "prov_id", source_kind(F.col("source_type")).alias("kind"), confidence_share(F.col("confidence")).alias("share"), F.col("ts").cast("timestamp").alias("ts"),
        F.coalesce(F.col("raw_value").rlike("[0-9]"), F.lit(False)).alias("usable"), F.coalesce(F.col("location").rlike(r"(?U)\S"), F.lit(False)).alias("placed"), *["raw_value", "location"] * texts,
    )
    return written(rows, "p2-figures")


def _trust(share: str = "share", kind: str = "kind") -> list[Column]:
    rank = F.when(F.col(kind) == "xml", 0).when(F.col(kind) == "text", 1).when(F.col(kind) == "ocr", 2).otherwise(3)
    return [F.coalesce(-F.col(share), F.lit(1)), rank]


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Survivor of each group of records of one figure, and where its raw value and location come from.

    The precedence is learnt of the source kinds. As the kind ranks before the
    time stamp here, rows that tie in it have the same level, and the order
    is the stated one: latest stamp, null last, then the smallest id.
    """
    rows = _figures(spark, sf_dir)
    learnt = survivors.learn_precedence(rows, _FIGURE, "kind", "ts")
    ranks = [*_trust(), *survivors.latest_first(F.col("ts"), learnt.level(F.col("kind")), stamps_first=True)]
    ids = {"raw_from_id": F.col("usable"), "location_from_id": F.col("placed")}
    return survivors.best_of_groups(rows, _FIGURE, "prov_id", ranks, ids).select("group_id", "survivor_id", "raw_from_id", "location_from_id")


def p2_golden(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record built per figure: the most trusted raw value and location, and the most current raw value, where a record without stamp is placed by its source kind."""
    rows = _figures(spark, sf_dir, texts=True)
    level = survivors.learn_precedence(rows, _FIGURE, "kind", "ts").level(F.col("kind"))
    trusted = [*_trust(), *survivors.latest_first(F.col("ts"), level, stamps_first=True)]
    values = {
        "raw_value": (trusted, F.col("usable"), F.trim("raw_value")),
        "location": (trusted, F.col("placed"), F.trim("location")),
        "confidence": (trusted, F.lit(True), F.col("share") / 100),
        "latest_ts": (survivors.latest_first(F.col("ts"), level, stamps_first=True), F.lit(True), F.col("ts")),
    }
    order = survivors.partial_order_values("current", F.col("ts"), level, F.col("usable"), F.trim("raw_value"))
    golden = survivors.best_of_groups(rows, _FIGURE, "prov_id", trusted, {}, values | order)
    current_raw = survivors.topologically_latest("current").alias("current_raw")
    return golden.select("group_id", "n_rows", "survivor_id", F.col("fld").alias("field"), F.floor((F.col("quarter") - 1) / 4).cast("int").alias("year"), (F.pmod(F.col("quarter") - 1, F.lit(4)) + 1).cast("int").alias("quarter"), "raw_value", "location", current_raw, "confidence", "latest_ts")


def p2_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counted transitions between source kinds, and whether the learnt precedence keeps them."""
    learnt = survivors.learn_precedence(_figures(spark, sf_dir), _FIGURE, "kind", "ts")
    return spark.createDataFrame(list(learnt.transitions), "earlier string, later string, seen bigint, reversed bigint, kept boolean")


def p3_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wordings learnt as aliases of a field of their section, with the documents whose figures speak for it."""
    return concepts.aliases(spark, sf_dir)


def _mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    items, entries = concepts.free_items(spark, sf_dir), concepts.reference_entries(spark, sf_dir)
    return canonical.map_to_reference(items, "concepto", ["sheet", "section"], entries, ["item_id", "sheet", "section", "concepto"])


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The canonical field each freely typed concept means, or ``none``."""
    return _mapped(spark, sf_dir).select("item_id", F.coalesce("target", F.lit("none")).alias("field"))


def p3_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wordings without a canonical field and how often each occurs."""
    return _mapped(spark, sf_dir).where("target is null").groupBy("sheet", "section", "concepto").agg(F.count("*").alias("n"))


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    return bpe.encode_column(table(spark, sf_dir, "documents"), "text", ["doc_id"])


def p8_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes."""
    return packing.pack_texts(table(spark, sf_dir, "documents"))


def p8_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How full the containers are: their number, the least number possible, and the share of space used."""
    packed = p8_pack(spark, sf_dir).where("container_id is not null")
    filled = packed.groupBy("container_id").agg(F.sum("n_tokens").alias("n"))
    total = filled.agg(F.count("*").alias("containers"), F.sum("n").alias("tokens"), F.max("n").alias("fullest"))
    return total.select("containers", F.ceil(F.col("tokens") / packing.CAPACITY).alias("least"), "fullest", F.round(F.col("tokens") / (F.col("containers") * packing.CAPACITY), 6).alias("used"))


def p9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main language (seg_no -1) and stretches of every document with confidence and place."""
    found = language.detect(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "seg_no", "lang", F.round("confidence", 4).alias("confidence"), "start_char", "end_char", "letters")


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose label doesn't name their language, and the stretches of mixed documents."""
    found = language.detect(table(spark, sf_dir, "documents"))
    wrong = (F.col("seg_no") == -1) & F.col("lang").isNotNull() & ~F.col("lang").eqNullSafe(F.col("labelled"))
    return found.where(wrong | ((F.col("seg_no") >= 0) & F.col("mixed"))).select("doc_id", "seg_no", "lang")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p2_found": p2_found,
    "p2_golden": p2_golden,
    "p2_precedence": p2_precedence,
    "p3_found": p3_found,
    "p3_unmatched": p3_unmatched,
    "p3_aliases": p3_aliases,
    "p7_ids": p7_ids,
    "p8_pack": p8_pack,
    "p8_fill": p8_fill,
    "p9_found": p9_found,
    "p9_language": p9_language,
}

_P2 = """
with p as (
  select prov_id, ts, raw_value, location,
         regexp_replace(filer_id, '[^0-9]', '', 'g') as filer, regexp_replace(segment_id, '[^0-9]', '', 'g') as segment,
         regexp_extract(period, '[0-9]{4}') as year,
         replace(replace(replace(replace(replace(regexp_extract(regexp_replace(upper(period), '[0-9]{4}', ''), '(IV|III|II|I|[1-4])'), 'IV', '4'), 'III', '3'), 'II', '2'), 'I', '1'), ' ', '') as quarter,
         regexp_replace(lower(trim(field)), '[ _-]+', '_', 'g') as fld,
         round(case when confidence > 1 then confidence else confidence * 100 end)::int as share,
         case when lower(source_type) like '%ocr%' then 2 when lower(source_type) in ('xml', 'xbrl') then 0 when source_type is null then 3 else 1 end as kind
  from provenance
), r as (
  select *, row_number() over (partition by filer, segment, year, quarter, fld order by share desc nulls last, kind, ts desc nulls last, prov_id) as rn from p
)
select min(prov_id) as group_id, max(case when rn = 1 then prov_id end) as survivor_id,
       coalesce(arg_min(prov_id, rn) filter (regexp_matches(raw_value, '[0-9]')), max(case when rn = 1 then prov_id end)) as raw_from_id,
       coalesce(arg_min(prov_id, rn) filter (trim(location) <> ''), max(case when rn = 1 then prov_id end)) as location_from_id
from r group by filer, segment, year, quarter, fld having count(*) >= 2
"""

_P2_TRANSITIONS = """
with p as (
  select regexp_replace(filer_id, '[^0-9]', '', 'g') as filer, regexp_replace(segment_id, '[^0-9]', '', 'g') as segment, regexp_extract(period, '[0-9]{4}') as year,
         replace(replace(replace(replace(regexp_extract(regexp_replace(upper(period), '[0-9]{4}', ''), '(IV|III|II|I|[1-4])'), 'IV', '4'), 'III', '3'), 'II', '2'), 'I', '1') as quarter,
         regexp_replace(lower(trim(field)), '[ _-]+', '_', 'g') as fld,
         case when lower(source_type) like '%ocr%' then 'ocr' when lower(source_type) in ('xml', 'xbrl') then 'xml' when lower(source_type) like '%pdf%' then 'text' end as kind, ts
  from provenance
), f as (
  select filer, segment, year, quarter, fld, kind, min(ts) as t from p where ts is not null and kind is not null group by all
), kinds as (select distinct kind from f), n as (
  select a.kind as earlier, b.kind as later, count(*) as n from f a join f b
  on a.filer = b.filer and a.segment = b.segment and a.year = b.year and a.quarter = b.quarter and a.fld = b.fld and a.t < b.t group by 1, 2
), pairs as (
  select x.kind as earlier, y.kind as later, coalesce(n.n, 0) as seen, coalesce(m.n, 0) as reversed from kinds x join kinds y on x.kind <> y.kind
  left join n on n.earlier = x.kind and n.later = y.kind left join n m on m.earlier = y.kind and m.later = x.kind
)
select earlier, later, seen, reversed, seen >= 5 and seen >= 1.2 * reversed as kept from pairs
"""

_P2_GOLDEN = f"""
with edges as (select earlier, later from ({_P2_TRANSITIONS}) where kept), kinds as (select distinct earlier as kind from ({_P2_TRANSITIONS})),
levels as (
  select kind, case when exists (select 1 from edges a join edges b on a.later = b.earlier where b.later = kind) then 2 when exists (select 1 from edges where later = kind) then 1 else 0 end as level from kinds
), p as (
  select prov_id, ts, trim(raw_value) as raw, trim(location) as loc, regexp_matches(coalesce(raw_value, ''), '[0-9]') as usable, trim(coalesce(location, '')) <> '' as placed,
         regexp_replace(filer_id, '[^0-9]', '', 'g') as filer, regexp_replace(segment_id, '[^0-9]', '', 'g') as segment, regexp_extract(period, '[0-9]{{4}}')::int as year,
         replace(replace(replace(replace(regexp_extract(regexp_replace(upper(period), '[0-9]{{4}}', ''), '(IV|III|II|I|[1-4])'), 'IV', '4'), 'III', '3'), 'II', '2'), 'I', '1')::int as quarter,
         regexp_replace(lower(trim(field)), '[ _-]+', '_', 'g') as fld, round(case when confidence > 1 then confidence else confidence * 100 end)::int as share,
         case when lower(source_type) like '%ocr%' then 'ocr' when lower(source_type) in ('xml', 'xbrl') then 'xml' when lower(source_type) like '%pdf%' then 'text' end as kind
  from provenance
), r as (
  select p.*, level,
         row_number() over (g order by share desc nulls last, case p.kind when 'xml' then 0 when 'text' then 1 when 'ocr' then 2 else 3 end, ts desc nulls last, prov_id) as rn,
         row_number() over (g order by ts desc nulls last, level desc nulls last, prov_id) as newest, row_number() over (g order by level desc nulls last, prov_id) as top
  from p left join levels on levels.kind = p.kind window g as (partition by filer, segment, year, quarter, fld)
), a as (
  select min(prov_id) as group_id, count(*) as n_rows, arg_min(prov_id, rn) as survivor_id, fld as field, year, quarter, arg_min(raw, rn) filter (usable) as raw_value, arg_min(loc, rn) filter (placed) as location,
         arg_min(coalesce(share, -1), rn) as s, max(ts) as latest_ts,
         arg_min(raw, newest) filter (usable and ts is not null) as stamped, arg_min(coalesce(level, -1), newest) filter (usable and ts is not null) as stamped_level,
         arg_min(raw, top) filter (usable and ts is null) as unstamped, arg_min(coalesce(level, -1), top) filter (usable and ts is null) as unstamped_level, max(level) filter (usable and ts is not null) as highest
  from r group by filer, segment, year, quarter, fld having count(*) >= 2
)
select group_id, n_rows, survivor_id, field, year, quarter, raw_value, location, case when s >= 0 then s / 100.0 end as confidence, latest_ts,
       case when stamped is null or (stamped_level >= 0 and unstamped_level > highest) then unstamped else stamped end as current_raw
from a
"""

SQL: dict[str, str] = {"p2_found": _P2, "p2_precedence": _P2_TRANSITIONS, "p2_golden": _P2_GOLDEN}
