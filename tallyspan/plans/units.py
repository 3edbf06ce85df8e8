"""Queries of problem 1 over kpi_value and xbrl_fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan.functions.keys import coded_id, field_name
from tallyspan.operators import units as U
from tallyspan.session import ship_package, written
from tallyspan.sources.tables import rule_rows, table


#: Columns that may state a unit, in order of trust, and how each says it.
SAID = {"said_unit": U.spelling_key, "said_text": U.spelling_key, "said_label": U.said_in_pair}


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both tables in the common form that true_units takes, with the unit each reading is due in.

    A written table: the texts are taken apart once, and the passes that
    follow read narrow columns. The filter on ``first`` comes after it, so that
    it doesn't evaluate the number parser a second time.
    """
    unit_rows = rule_rows(table(spark, sf_dir, "unit_ref"))
    base = {u.unit_code: u.quantity for u in sorted(unit_rows, key=lambda u: bool(u.is_base))}
    fields = [r for r in rule_rows(table(spark, sf_dir, "field_rule")) if r.sheet == "sheet2" and r.unit in base]
    rules = F.broadcast(spark.createDataFrame([(r.field, r.unit, base[r.unit], r.label) for r in fields], "f string, usual string, quantity string, rule_label string"))
    kpi = table(spark, sf_dir, "kpi_value").select("value_id", "segment_id", "quarter", "field", "value", "value_text", "unit", "label")
    kpi = kpi.withColumn("__f", field_name(F.col("field"))).join(rules, F.col("__f") == F.col("f")).withColumn("token", U.number_token(F.col("value_text")))
    first, other = U.readings_of(F.col("token"), point_first=False)
    value = F.when(~F.isnan("value"), F.col("value"))
    kpi = kpi.select(
        F.lit("kpi_value").alias("row_table"), F.col("value_id").alias("row_id"), coded_id(F.col("segment_id"), "SG", 9).alias("segment"),
        F.concat(F.lit("kpi "), "f").alias("fkey"), (F.col("quantity") != "price").alias("scales"), "quantity", "usual", F.col("usual").alias("due"),
        F.when(F.col("quantity") == "price", 1).otherwise(F.greatest(F.lit(1), F.coalesce("quarter", F.lit(1)))).alias("spread"),
        F.abs(F.coalesce(value, first)).alias("first"), F.when(value.isNull(), F.abs(other)).alias("other"),
        F.col("unit").alias("said_unit"), U.text_rest(F.col("value_text")).alias("said_text"), U.label_pair(F.col("label"), F.col("rule_label")).alias("said_label"),
    )
    mapped = [(n, m.field) for m in rule_rows(table(spark, sf_dir, "fact_mapping")) if m.apply_scaling for n in [m.primary_fact, *(m.fallbacks or [])]]
    names = F.broadcast(spark.createDataFrame(mapped, "n string, f string").groupBy("n").agg(F.min("f").alias("f")))
    facts = table(spark, sf_dir, "xbrl_fact").select("fact_id", "doc_id", "name", "value", "unit_ref").join(names, F.trim("name") == F.col("n"))
    facts = facts.withColumns({"token": U.number_token(F.col("value")), "said": U.text_rest(F.col("value"))})
    said = F.col("said")
    point, point_other = U.readings_of(F.col("token"), point_first=True)
    comma, comma_other = U.readings_of(F.col("token"), point_first=False)
    facts = facts.select(
        F.lit("xbrl_fact").alias("row_table"), F.col("fact_id").alias("row_id"), coded_id(F.regexp_extract("doc_id", r"^(.*?)_[0-9]{4}", 1), "SG", 9).alias("segment"),
        F.concat(F.lit("fact "), "f").alias("fkey"), F.lit(True).alias("scales"), F.lit("money").alias("quantity"), F.lit("usd").alias("usual"), F.lit("usd").alias("due"),
        F.greatest(F.lit(1), F.coalesce(F.regexp_extract("doc_id", r"[0-9]{4}Q([1-4])$", 1).try_cast("int"), F.lit(1))).alias("spread"),
        F.nullif(F.when(said.isNull(), point).otherwise(comma), F.lit(0.0)).alias("first"), F.when(said.isNull(), point_other).otherwise(comma_other).alias("other"),
        F.col("unit_ref").alias("said_unit"), said.alias("said_text"), F.lit(None).cast("string").alias("said_label"),
    )
    return written(kpi.unionByName(facts), "p1-readings").where("first is not null")


def resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every reading with the unit it is really in."""
    ship_package(spark)
    rows = U.resolve_stated(readings(spark, sf_dir), SAID)
    return U.true_units(rows, rule_rows(table(spark, sf_dir, "unit_ref")))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that are really in another unit than the one due."""
    return resolved(spark, sf_dir).where("unit_code <> due").select("row_table", "row_id", "unit_code")


def p1_converted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every reading in the unit due for its field."""
    unit_rows = rule_rows(table(spark, sf_dir, "unit_ref"))
    rows = resolved(spark, sf_dir)
    factor = F.pow(F.lit(10.0), U.log_factor(F.col("quantity"), F.col("unit_code"), unit_rows) - U.log_factor(F.col("quantity"), F.col("due"), unit_rows))
    return rows.select("row_table", "row_id", "unit_code", "due", "how", F.round(F.col("first") * factor, 6).alias("magnitude"))


def p1_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct unit spellings with the code they map to, null where none fits."""
    ship_package(spark)
    texts = U.stated_texts(readings(spark, sf_dir), SAID)
    counted = texts.groupBy("quantity", "spelling").agg(F.sum("n").alias("n"))
    return counted.join(U.alias_dictionary(texts), ["quantity", "spelling"], "left").select("quantity", "spelling", "n", "code", F.round("apart", 4).alias("apart"))
