"""Problem 2: precedence, partial orders, survivors."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyspan.llm import queries, survivors

DAY = datetime(2024, 1, 1)


def rows_of(spark, rows):
    return spark.createDataFrame(rows, "g string, id bigint, v string, ts timestamp")


def test_learns_what_replaces_what(spark):
    rows, i = [], 0
    for g in range(40):
        chain = ["draft", "final", "audited"] if g % 8 else ["final", "draft", "audited"]
        for k, v in enumerate(chain):
            rows.append((f"g{g}", i, v, DAY + timedelta(days=k)))
            i += 1
    rows += [(None, i, "draft", DAY), ("g0", i + 1, None, DAY), ("g0", i + 2, "final", None)]
    learnt = survivors.learn_precedence(rows_of(spark, rows), ["g"], "v", "ts")
    assert learnt.levels == {"draft": 0, "final": 1, "audited": 2}
    assert survivors.learn_precedence(rows_of(spark, rows).where("false"), ["g"], "v", "ts").levels == {}
    with pytest.raises(ValueError):
        survivors.learn_precedence(rows_of(spark, [("g", n, f"v{n}", DAY) for n in range(40)]), ["g"], "v", "ts")


def test_levels():
    assert survivors.topological_levels(["a", "b", "c"], [("a", "b"), ("b", "c"), ("a", "c")]) == {"a": 0, "b": 1, "c": 2}
    assert survivors.topological_levels(["a", "b"], [("a", "b"), ("b", "a")]) is None


def test_latest_without_stamps(spark):
    level = F.when(F.col("v") == "final", 1).otherwise(0)
    rows = rows_of(spark, [("a", 1, "draft", DAY), ("a", 2, "final", None), ("b", 3, "draft", DAY), ("b", 4, "draft", DAY + timedelta(1)), ("b", 5, "draft", None), ("c", 6, "final", None)])
    by = lambda first: {r.g: r.survivor_id for r in survivors.best_of_groups(rows, ["g"], "id", survivors.latest_first(F.col("ts"), level, first), {}).collect()}
    assert by(False) == {"a": 2, "b": 4}
    assert by(True) == {"a": 1, "b": 4}


def test_ids_and_values(spark):
    df = spark.createDataFrame([("g", 3, 1, None, True), ("g", 2, 2, "x", None), ("g", 1, 2, "y", False), ("h", 4, 0, "z", True), ("h", 4, 0, "z", True), (None, 5, 0, "q", True), (None, 6, 0, "q", True), ("i", None, 0, "n", True), ("i", 7, 0, "n", True)], "g string, id bigint, r int, n_rows string, ok boolean")
    got = survivors.best_of_groups(df, ["g"], "id", [F.col("r")], {"with_text": F.col("n_rows").isNotNull(), "never": F.lit(False)}, {"text": ([F.col("r")], F.col("n_rows").isNotNull(), F.col("n_rows"))})
    assert sorted(tuple(r) for r in got.collect()) == [("g", 1, 3, 3, 1, 3, "y"), ("h", 4, 2, 4, 4, 4, "z")]
    assert survivors.best_of_groups(df.where("false"), ["g"], "id", [F.col("r")], {}).count() == 0


def test_hot_group(spark):
    df = spark.range(30_000).select(F.lit("hot").alias("g"), "id", (F.col("id") % 7).alias("r"))
    assert survivors.best_of_groups(df, ["g"], "id", [-F.col("r")], {}).first().survivor_id == 6


def test_spellings(spark):
    kinds = ["xml", "XML", "xbrl", "PDF text", "pdf-text", "pdf_ocr", "OCR", None, "", "other"]
    df = spark.createDataFrame([(i, k) for i, k in enumerate(kinds)], "i int, k string").orderBy("i")
    assert [r[0] for r in df.select(queries.source_kind(F.col("k"))).collect()] == ["xml"] * 3 + ["text"] * 2 + ["ocr"] * 2 + [None] * 3
    shares = [0.9, 90.0, 1.0, 100.0, 0.905, None, float("nan"), 0.0]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(shares)], "i int, s double").orderBy("i")
    assert [r[0] for r in df.select(queries.confidence_share(F.col("s"))).collect()] == [90, 90, 100, 100, 91, None, None, 0]
