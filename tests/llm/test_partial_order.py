"""Problem 2: the latest row of a group's partial order."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tallyspan.llm import queries, survivors

DAY = datetime(2024, 1, 1)


def latest(spark, rows):
    df = spark.createDataFrame(rows, "g string, id bigint, v int, ts timestamp")
    order = survivors.partial_order_values("c", F.col("ts"), F.col("v"), F.lit(True), F.col("id"))
    got = survivors.best_of_groups(df, ["g"], "id", [F.lit(0)], {}, order).select("g", survivors.topologically_latest("c").alias("id"))
    return {r.g: r.id for r in got.collect()}


def test_latest_of_partial_order(spark):
    after = lambda n: DAY + timedelta(n)
    assert latest(spark, [
        ("stamps before levels", 1, 2, DAY), ("stamps before levels", 2, 0, after(1)),
        ("newest of unknown level", 3, 1, DAY), ("newest of unknown level", 4, None, after(1)),
        ("unknown is not comparable", 5, 2, None), ("unknown is not comparable", 6, None, DAY),
        ("unstamped replaces", 7, 0, DAY), ("unstamped replaces", 8, 1, None),
        ("unstamped is replaced", 9, 1, DAY), ("unstamped is replaced", 10, 0, None),
        ("unstamped of unknown level", 11, 0, DAY), ("unstamped of unknown level", 12, None, None),
        ("through an older row", 13, 2, DAY), ("through an older row", 14, 1, None), ("through an older row", 15, 0, after(1)),
        ("no stamps", 16, None, None), ("no stamps", 17, 1, None), ("no stamps", 18, 0, None),
    ]) == {
        "stamps before levels": 2, "newest of unknown level": 4, "unknown is not comparable": 6, "unstamped replaces": 8, "unstamped is replaced": 9,
        "unstamped of unknown level": 11, "through an older row": 15, "no stamps": 17,
    }


def test_current_raw_is_the_newest(spark, tmp_path):
    row = lambda i, kind, raw, day: (i, "EM-1", "SG-1", "2020_Q1", "costo", kind, "p", 0.9, day, raw)
    spark.createDataFrame([row(1, "xml", "10", DAY), row(2, None, "20", DAY + timedelta(1))], "prov_id long, filer_id string, segment_id string, period string, field string, source_type string, location string, confidence double, ts timestamp, raw_value string").write.parquet(f"{tmp_path}/provenance.parquet")
    assert queries.p2_golden(spark, str(tmp_path)).first().current_raw == "20"


def _filed(i, figure, kind, raw, day):
    return (i, "EM-1", "SG-1", "2020_Q1", figure, kind, "p", 0.9, day, raw)


_SHAPE = "prov_id long, filer_id string, segment_id string, period string, field string, source_type string, location string, confidence double, ts timestamp, raw_value string"


def test_precedence_decides_rows(spark, tmp_path):
    """A learnt precedence (text, then XML) changes the current value of a record without stamp; without it the row is another."""
    taught = [_filed(10 * g + k, f"f{g}", kind, str(g), DAY + timedelta(k)) for g in range(1, 9) for k, kind in enumerate(("pdf text", "xml"))]
    asked = [_filed(1, "costo", "pdf text", "10", DAY), _filed(2, "costo", "xml", "20", None)]
    current = lambda rows, at: (spark.createDataFrame(rows, _SHAPE).write.parquet(f"{at}/provenance.parquet"), {r.field: r.current_raw for r in queries.p2_golden(spark, str(at)).collect()})[1]["costo"]
    assert current([*taught, *asked], tmp_path / "on") == "20"
    assert current(asked, tmp_path / "off") == "10"


def test_precedence_of_an_unranked_attribute(spark):
    """Rows of equal rank without stamps: the learnt level picks the survivor, and switched off it is another."""
    rows = [(f"g{g}", 10 * g + k, v, DAY + timedelta(k)) for g in range(1, 9) for k, v in enumerate(("draft", "final"))]
    df = spark.createDataFrame([*rows, ("asked", 1, "draft", None), ("asked", 2, "final", None)], "g string, id bigint, v string, ts timestamp")
    level = survivors.learn_precedence(df, ["g"], "v", "ts").level(F.col("v"))
    survivor = lambda lv: {r.g: r.survivor_id for r in survivors.best_of_groups(df, ["g"], "id", survivors.latest_first(F.col("ts"), lv, stamps_first=True), {}).collect()}["asked"]
    assert survivor(level) == 2 and survivor(F.lit(None).cast("int")) == 1
