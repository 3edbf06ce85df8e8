"""Operators over tagged facts and their contexts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspan.functions.numbers import scale_floor, scale_trunc
from tallyspan.functions.periods import quarter_end
from tallyspan.operators.select import pick_first
from tallyspan.sources.tables import broadcast_if_small, with_each


def with_contexts(facts: DataFrame, contexts: DataFrame) -> DataFrame:
    """Facts with their context's columns, null where it is missing. Of repeated contexts the first counts, so no fact is multiplied."""
    columns = ["period_type", "instant", "start_date", "end_date", "entity_id"]
    first = pick_first(contexts, ["doc_id", "ctx_id"], [F.col("ctx_ord")], columns)
    return facts.join(first.withColumnRenamed("ctx_id", "context_ref"), ["doc_id", "context_ref"], "left")


def facts_named(facts: DataFrame, name: str, exact: bool = True) -> DataFrame:
    return facts.where(F.col("name") == name if exact else F.lower("name").contains(name.lower()))


def latest_context(contexts: DataFrame) -> DataFrame:
    """The duration context of each document that ends last (ISO dates), the first among equals. A date that isn't one counts as the earliest."""
    ended = contexts.where((F.col("period_type") == "duration") & F.col("end_date").isNotNull())
    latest = -F.coalesce(F.unix_date(F.try_to_date("end_date")), F.lit(-(2**31)))
    return pick_first(ended, ["doc_id"], [latest, F.col("ctx_ord")], ["ctx_id", "end_date"])


def chosen_context(contexts: DataFrame, year: Column, quarter: Column, yearly: bool = False) -> DataFrame:
    """``(doc_id, ctx_id, strategy)``: the context that holds a document's current figures.

    By id pattern first, then by exact dates, then the duration that ends last
    (for yearly figures: any instant within the year). Document order decides
    among equals. ``year`` and ``quarter`` are expressions over the contexts.
    """
    pattern, other = ("AcumuladoAnoActual", None) if yearly else ("AcumuladoActual", "AcumuladoAnoActual")
    named = F.col("ctx_id").contains(pattern)
    if other:
        named = named & ~F.col("ctx_id").contains(other)
    duration = F.col("period_type") == "duration"
    end = F.concat(year.cast("string"), F.lit("-12-31")) if yearly else quarter_end(year, quarter)
    dated = duration & (F.col("start_date") == F.concat(year.cast("string"), F.lit("-01-01"))) & (F.col("end_date") == end)
    last = (F.col("period_type") == "instant") & F.col("instant").startswith(year.cast("string")) if yearly else duration & F.col("end_date").isNotNull()
    strategy = F.when(named, 1).when(dated, 2).when(last, 3)
    ranked = contexts.withColumn("strategy", strategy).where("strategy is not null")
    newest = F.when((F.col("strategy") == 3) & F.lit(not yearly), -F.unix_date(F.try_to_date("end_date"))).otherwise(0)
    return pick_first(ranked, ["doc_id"], [F.col("strategy"), newest, F.col("ctx_ord")], ["ctx_id", "strategy"])


def instant_of_year(contexts: DataFrame, year: Column) -> DataFrame:
    """``(doc_id, ctx_id, strategy)``: the first instant within a document's year, to follow where the chosen yearly context is a duration that holds no instant facts."""
    there = contexts.where((F.col("period_type") == "instant") & F.col("instant").startswith(year.cast("string"))).withColumn("strategy", F.lit(4))
    return pick_first(there, ["doc_id"], [F.col("ctx_ord")], ["ctx_id", "strategy"])


def number_text(c: Column) -> Column:
    """A fact's number; texts that are none give null."""
    return F.trim(F.regexp_replace(c, r"\s+", " ")).try_cast("double")


def mapped_values(facts: DataFrame, mappings: DataFrame, duration: DataFrame, instant: DataFrame | None = None, factor: int = 1000, floor: bool = False) -> DataFrame:
    """``(doc_id, field, value, fact)``: the mapped fields' values of each document.

    ``mappings`` (small, broadcast): field, primary_fact, fallbacks,
    context_type, apply_scaling, ensure_negative, default_value. The first
    name with a readable value in the chosen context counts; of a name's
    repeated facts the first decides. ``instant`` may hold several contexts of
    a document, tried in the order of their ``strategy``. Values are scaled towards zero (``floor``:
    down), made negative where asked, and default where missing. Fields without
    value and default don't come out.
    """
    names = mappings.select("field", "context_type", "apply_scaling", "ensure_negative", F.posexplode(F.concat(F.array("primary_fact"), F.coalesce("fallbacks", F.array().cast("array<string>")))).alias("rank", "name"))
    chosen = duration.select("doc_id", F.col("ctx_id").alias("context_ref"), F.lit("duration").alias("context_type"), F.lit(0).alias("turn"))
    if instant is not None:
        chosen = chosen.unionByName(instant.select("doc_id", F.col("ctx_id").alias("context_ref"), F.lit("instant").alias("context_type"), F.col("strategy").alias("turn")))
    slim = facts.select("doc_id", "name", "context_ref", "value", "fact_ord").join(broadcast_if_small(names), "name")
    there = slim.join(chosen, ["doc_id", "context_ref", "context_type"])
    by_name = pick_first(there, ["doc_id", "field", "turn", "rank"], [F.col("fact_ord")], ["name", "value", "apply_scaling", "ensure_negative"])
    read = by_name.withColumn("v", number_text(F.col("value")))
    best = pick_first(read, ["doc_id", "field"], [F.col("turn"), F.col("rank")], ["name", "v", "apply_scaling", "ensure_negative"], F.col("v").isNotNull())
    scaled = F.when(F.col("apply_scaling"), (scale_floor if floor else scale_trunc)(F.col("v"), factor).cast("double")).otherwise(F.col("v"))
    value = F.when(F.col("ensure_negative") & (scaled > 0), -scaled).otherwise(scaled)
    found = best.select("doc_id", "field", value.alias("value"), F.col("name").alias("fact"))
    defaults = mappings.where("default_value is not null").select("field", F.col("default_value").alias("value"))
    absent = with_each(duration.select("doc_id"), defaults).join(found.select("doc_id", "field"), ["doc_id", "field"], "left_anti")
    return found.unionByName(absent.select("doc_id", "field", "value", F.lit(None).cast("string").alias("fact")))


def year_to_date_max(facts: DataFrame, contexts: DataFrame, name: str | None = None, factor: int = 1000) -> DataFrame:
    """``(doc_id, name, ytd)``: greatest scaled value (rounded down) of each fact, or of one, per document among contexts that start on the first of January."""
    dated = with_contexts(facts if name is None else facts_named(facts, name), contexts).where(F.col("start_date").endswith("-01-01"))
    return dated.groupBy("doc_id", "name").agg(F.max(scale_floor(number_text(F.col("value")), factor)).alias("ytd")).where("ytd is not null")


def fact_categories(facts: DataFrame) -> DataFrame:
    """Facts by the first capitalised word of their name."""
    return facts.groupBy(F.regexp_extract("name", r"[A-Z][a-z]*", 0).alias("category")).agg(F.count("*").alias("n"))


def units(facts: DataFrame) -> DataFrame:
    """Distinct unit ids with their label: the currency code where they name one."""
    code = F.nullif(F.regexp_extract("unit_ref", r"iso4217[:_]([A-Z]{3})", 1), F.lit(""))
    return facts.where("unit_ref is not null").select("unit_ref").distinct().select("unit_ref", F.coalesce(code, F.col("unit_ref")).alias("label"))
