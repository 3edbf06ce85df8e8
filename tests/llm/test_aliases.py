"""Problem 3: aliases are learnt from figures, without a list of wordings."""

import random

import pytest
from pyspark.sql import functions as F

from tallyspan.llm import canonical, concepts

FIELDS = [("s", "a", f"f{i}") for i in range(6)] + [("s", "b", "only")]


def learn(spark, items, evidence, **needed):
    rows = spark.createDataFrame(items, "sheet string, section string, text string, doc bigint, keys array<bigint>")
    known = spark.createDataFrame(evidence, "field string, key bigint").withColumn("text", F.lit("clash"))
    fields = spark.createDataFrame(FIELDS, "sheet string, section string, field string")
    got = concepts.learn_aliases(rows, known, fields, ["sheet", "section"], concepts.Evidence(**needed))
    return {(r.section, r.entry): (r.target, r.hits) for r in got.collect()}


def test_wordings_that_keep_to_one_field(spark):
    items, evidence = [], []
    for d in range(60):
        evidence += [(f"f{i}", d * 10 + i) for i in range(6)] + [("only", d * 10 + 9)] * 2
        # an alias keeps to f1; a wording without field takes any figure, also in the section of one field
        items += [("s", "a", "Gasto  uno:", d, [d * 10 + 1, -1])] * 2
        items += [("s", "a", "cierre", d, [d * 10 + d % 6]), ("s", "b", "cierre", d, [d * 10 + 9])]
        items += [("s", "b", "Ventas netas", d, [d * 10 + 9]), ("s", "a", None, d, [d * 10])]
    items += [("s", "a", "raro", 0, [2]), ("s", "a", "raro", 0, [2]), ("s", "z", "Gasto uno", 0, [1]), (None, "a", "Gasto uno", 0, [1]), ("s", "a", "", 3, [31])]
    assert learn(spark, items, evidence) == {("a", "gasto uno"): ("f1", 60), ("b", "ventas netas"): ("only", 60)}
    assert learn(spark, items, evidence, documents=61) == {}


def test_support_bounds_the_list(spark):
    """Spellings that carry less than their share of a field's hits are left to the tree."""
    items = [("s", "a", "Suministro electrico", d, [d]) for d in range(300)] + [("s", "a", "Suministro electrixo", d, [d]) for d in range(2)]
    evidence = [("f1", d) for d in range(300)]
    assert set(learn(spark, items, evidence)) == {("a", "suministro electrico")}
    assert len(learn(spark, items, evidence, support=0.0)) == 2


def test_empty(spark):
    assert learn(spark, [], [("f1", 1)]) == {} and learn(spark, [("s", "a", "x", 1, [1])], []) == {}


def test_keys_of_notations(spark):
    df = spark.createDataFrame([(11079000.0, "11.079"), (138.1, "138100"), (0.0965, "97"), (-3134.0, "(3.134)"), (1234.0, "MUS$ 1.234,00")], "n double, t string")
    shared = df.select(F.size(F.array_intersect(concepts.number_keys(F.col("n")), concepts.text_keys(F.col("t")))).alias("k")).collect()
    assert all(r.k for r in shared)
    assert [r.k for r in spark.createDataFrame([(None, None), (0.0, ""), (float("nan"), "-")], "n double, t string").select(F.size(F.coalesce(F.array_union(concepts.number_keys(F.col("n")), concepts.text_keys(F.col("t"))), F.array())).alias("k")).collect()] == [0, 0, 0]


@pytest.mark.parametrize("scale", ["sf0.01"])
def test_recall_of_planted_wordings(spark, tmp_path, scale):
    """Labels renamed to made-up wordings in half of the documents come back as their fields from the figures alone."""
    import os

    data = f"/root/testdata/{scale}"
    if not os.path.isdir(data):
        pytest.skip("no test data here")
    rng = random.Random(5)
    words = ["".join(rng.choice("bcdfghjklmnprstvz") + rng.choice("aeiou") for _ in range(5)) for _ in range(400)]
    rules = spark.read.parquet(f"{data}/field_rule.parquet").select("sheet", "section", "field", "label").collect()
    made = {(r.sheet, r.section, r.label): f"{words[2 * i]} {words[2 * i + 1]}" for i, r in enumerate(rules)}
    new = spark.createDataFrame([(*k, v, r.field) for (k, v), r in zip(made.items(), rules)], "sheet string, section string, concepto string, made string, due string")
    items = spark.read.parquet(f"{data}/line_item.parquet").join(F.broadcast(new), ["sheet", "section", "concepto"], "left")
    half = F.col("made").isNotNull() & (F.xxhash64("doc_id") % 2 == 0)
    items.withColumn("concepto", F.when(half, F.col("made")).otherwise(F.col("concepto"))).withColumn("due", F.when(half, F.col("due"))).write.parquet(f"{tmp_path}/line_item.parquet")
    for name in ("field_rule", "keyword_rule", "value_pdf", "value_xbrl", "kpi_value", "provenance", "xbrl_fact", "fact_mapping", "sheet_file"):
        os.symlink(f"{data}/{name}.parquet", f"{tmp_path}/{name}.parquet")
    mapped = canonical.map_to_reference(concepts.free_items(spark, str(tmp_path)).join(spark.read.parquet(f"{tmp_path}/line_item.parquet").select("item_id", "due"), "item_id").where("due is not null"), "concepto", ["sheet", "section"], concepts.reference_entries(spark, str(tmp_path)), ["due"])
    n, right, wrong = mapped.agg(F.count("*"), F.count_if(F.col("target") == F.col("due")), F.count_if(F.col("target") != F.col("due"))).first()
    assert n > 500 and right / n >= 0.9 and wrong / n <= 0.01, (n, right, wrong)
