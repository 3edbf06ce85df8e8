"""Selection, validation, formulas, matching, grids, segments and merging on small cases."""

import pytest
from pyspark.sql import functions as F

from tallyspan.operators import formula, grids, matching, merge, reshape, segments, select, similarity, validate


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_pick_first_ignores_row_order(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("a", 1, None), ("b", None, "z")], "k string, o int, v string")
    for parts in (1, 5):
        assert rows(select.pick_first(df.repartition(parts), ["k"], [F.col("o"), F.col("v")], ["v"])) == [("a", None), ("b", "z")]
    assert rows(select.pick_first(df, ["k"], [F.col("o"), F.col("v")], ["v"], F.col("v").isNotNull())) == [("a", "y"), ("b", "z")]
    assert select.pick_first(df.where("false"), ["k"], [F.col("o")], ["v"]).count() == 0
    assert select.pick_first(df.where("false"), [], [F.col("o")], ["v"]).count() == 0


def test_fallback_chain(spark):
    facts = spark.createDataFrame([("d", "B", 1, 5.0), ("d", "A", 1, None), ("e", "B", 1, 7.0)], "doc string, name string, ord int, value double")
    wanted = spark.createDataFrame([("A", 1), ("B", 2)], "name string, rank int")
    assert rows(select.fallback_chain(facts, wanted, "name", "rank", ["doc"], [F.col("ord")], "value")) == [("d", "B", 5.0), ("e", "B", 7.0)]
    assert rows(select.fallback_chain(facts, wanted, "name", "rank", ["doc"], [F.col("ord")], "value", need_value=False)) == [("d", "A", None), ("e", "B", 7.0)]


@pytest.mark.parametrize(
    "a,b,t,nulls,signed,match",
    [(100, 100, 1, "pass", False, True), (100, 101, 5, "pass", False, True), (100, 110, 5, "pass", False, False), (-100, 100, 1, "pass", False, True), (-100, 100, 1, "pass", True, False),
     (None, 100, 1, "pass", False, True), (None, 100, 1, "fail", False, False), (None, 1, 1, "zero", False, True), (None, 1, 1, "skip", False, None)],
)
def test_tolerance_match(spark, a, b, t, nulls, signed, match):
    df = spark.createDataFrame([(a, b)], "a bigint, b bigint")
    assert df.select(validate.tolerance_match(F.col("a"), F.col("b"), t, nulls, signed)).first()[0] == match


def test_sum_check(spark):
    values = spark.createDataFrame([("p", "a", 100), ("p", "b", 20), ("p", "t", 140), ("q", "a", None), ("q", "t", None), ("r", "t", 2)], "k string, field string, value bigint")
    rules = spark.createDataFrame([("s", "a", False, None), ("s", "b", False, None), ("s", "t", True, None), ("loose", "a", False, 5.0), ("loose", "t", True, 5.0)], "rule string, field string, is_total boolean, tolerance double")
    got = {(r.k, r.rule): (r.expected, r.actual, r.match) for r in validate.sum_check(values, rules, ["k"]).collect()}
    assert got["p", "s"] == (120, 140, False) and got["q", "s"] == (0, None, True) and got["r", "s"] == (0, 2, False) and got["r", "loose"] == (0, 2, True)


def test_source_check(spark):
    a = spark.createDataFrame([("x", -100), ("y", 5), ("z", None)], "k string, value bigint")
    b = spark.createDataFrame([("x", 110), ("w", 7), ("z", None)], "k string, value bigint")
    got = {r.k: (r.source, r.match, r.difference, r.value) for r in validate.source_check(a, b, ["k"]).collect()}
    assert got == {"x": ("both", False, 10, -100), "y": ("pdf_only", True, 0, 5), "w": ("xbrl_only", True, 0, 7)}


def test_reference_and_section(spark):
    ref = spark.createDataFrame([("a", 100.0, True), ("b", 2.0, False), ("c", 0.0, False), ("d", 1.0, True)], "k string, expected double, is_int boolean")
    act = spark.createDataFrame([("a", 101.0), ("b", 2.1), ("c", 9.0)], "k string, value double")
    assert {r.k: r.match for r in validate.reference_check(ref, act, ["k"]).collect()} == {"a": True, "b": False, "c": True, "d": False}
    items = spark.createDataFrame([("s", "x", 3), ("s", "y", None), ("s", "Totales", 3), ("t", "x", 3), ("u", None, 2), ("u", "Total", 2)], "s string, l string, v bigint")
    assert {r.s: r.match for r in validate.section_total(items, ["s"], "l", "v").collect()} == {"s": True, "t": False, "u": True}
    assert rows(validate.summary(spark.createDataFrame([("c", True), ("c", False)], "category string, match boolean"), "category")) == [("c", 2, 1, True)]


@pytest.mark.parametrize(
    "rule,match,difference",
    [("a - abs(b) == c", True, 0), ("abs(abs(b)) == 20", True, 0), ("-a + 110 == c * 1", True, 70), ("a / b == 1", True, None), ("min(a) == 1", True, None), ("a == b == c", True, None), ("a", True, None), ("a +", True, None), ("a == d", True, None), ("a == e", True, None), ("a == c", False, 20)],
)
def test_formula(spark, rule, match, difference):
    df = spark.createDataFrame([(100, -20, 80, None)], "a bigint, b bigint, c bigint, d bigint")
    names = {n: F.col(n) for n in "abcd"}
    tolerance = 70 if "110" in rule else 1
    r = df.select(formula.compile_rule(rule, names, tolerance).alias("r")).first().r
    assert (r.match, r.difference) == (match, difference)
    assert r.missing == {"a == d": ["d"], "a == e": ["e"], "min(a) == 1": ["min"]}.get(rule, [])


def test_match_label(one):
    labels = ["Total", "Costo de venta", "Gastos en personal", "Costo de venta total"]
    cases = {"COSTO DE VENTA TOTAL (neto)": "Costo de venta total", "costo de la venta": "Costo de venta", "gastos personal": None, "gastos en el personal": "Gastos en personal", "sub total": "Total", "otros": None, None: None, "": None}
    assert one(list(cases), lambda c: matching.match_label(c, labels)) == list(cases.values())
    assert one(["Suma total de"], lambda c: matching.match_label_or_total(c, ["x"])) == ["Totales"]


def test_keywords_pages_tables(spark, one):
    rules = [("x", ["amort"], ["leasing"]), ("y", ["leasing", "amort"], [])]
    assert one(["Amortización", "amort leasing", "z", None], lambda c: matching.match_keywords(c, rules)) == ["x", "y", None, None]
    pages = spark.createDataFrame([("d", 2, "Nota de COSTO y energía"), ("d", 1, "índice"), ("d", 3, "costo energia"), ("e", 1, None)], "doc string, page int, t string")
    assert rows(matching.find_page(pages, ["doc"], "page", "t", ["costo"], ["energía"], 1, 1)) == [("d", 2)]
    assert one(["abc XYZ def", "none", None], lambda c: matching.section_context(c, "xyz", 2, 4)["context"]) == ["c XYZ ", None, None]
    tables = spark.createDataFrame([("d", 1, "costo energia"), ("d", 0, "costo energia"), ("d", 2, "costo"), ("e", 0, "x")], "doc string, i int, t string")
    assert rows(matching.best_table(tables, ["doc"], "i", "t", ["Costo"], ["Energía"], [], 3)) == [("d", 0, 6)]


def test_grids(spark):
    grid = spark.createDataFrame(
        [("d", 0, ["Energía\nFletes", "1.000\n(5)", None, "-\n7"]), ("d", 1, ["Totales", "995", "3"]), ("d", 2, ["", "1"]), ("d", 3, None), ("d", 4, ["otro", "9"])], "doc string, row int, cells array<string>"
    )
    got = rows(grids.parse_grid(grid, ["doc"], "row", "cells", ["Energía", "Fletes"]))
    assert got == [("d", 0, 0, "Energía", [1000, None, None]), ("d", 0, 1, "Fletes", [-5, None, 7]), ("d", 1, 0, "Totales", [995, 3])]
    assert rows(grids.parse_grid(grid, ["doc"], "row", "cells", ["Energía", "Fletes"], compact=True))[0][-1] == [1000]
    items = grids.line_items(grids.parse_grid(grid, ["doc"], "row", "cells", ["Fletes"]), ["doc"])
    assert ("d", "Fletes", -5, None, 7, None) in rows(items)
    value = spark.createDataFrame([(["Nota 3\nIngresos de ventas", "12\n5.000"],), (["Costos", "9"],)], "cells array<string>").select(grids.value_from_row(F.col("cells"), ["ingresos"], 100))
    assert [r[0] for r in value.collect()] == [5000, None]


def test_markdown_tables(spark):
    text = "intro\n|a|b|\n|---|---|\n|1|2|\n\n| lone |\nend\n|c|\n|3|"
    got = rows(grids.markdown_tables(spark.createDataFrame([("d", text), ("e", None)], "doc string, t string"), ["doc"], "t"))
    assert got == [("d", 0, 0, ["a", "b"]), ("d", 0, 1, ["1", "2"]), ("d", 1, 0, ["c"]), ("d", 1, 1, ["3"])]


def test_segments(spark):
    lines = ["x", "START", "a", "END", "b", "START", "c", "bruta", "START", "d"]
    df = spark.createDataFrame([("d", i, t) for i, t in enumerate(lines)], "doc string, i int, t string")
    seg = segments.segment_rows(df, ["doc"], ["i"], F.col("t") == "START", F.col("t") == "END")
    assert [(r.t, r.seg_no) for r in seg.orderBy("i").collect()] == [("a", 1), ("c", 2), ("bruta", 2), ("d", 3)]
    for width in (1, 2, 3, 100):
        split = segments.segment_rows(df, ["doc"], ["i"], F.col("t") == "START", F.col("t") == "END", F.floor(F.col("i") / width))
        assert rows(split) == rows(seg)
    assert rows(segments.choose_segment(seg, ["doc"], F.col("t") == "bruta", 10)) == [("d", 2, 2)]
    assert rows(segments.choose_segment(seg, ["doc"], F.col("t") == "none", 1)) == [("d", 2, 2)]
    assert rows(segments.choose_segment(seg, ["doc"], F.col("t") == "none", 10)) == []


def test_merge(spark):
    a = spark.createDataFrame([("p", 1, None), ("q", 2, 3)], "k string, x int, y int")
    b = spark.createDataFrame([("p", 9, 5), ("r", 7, None)], "k string, x int, y int")
    assert rows(merge.coalesce_merge(a, b, ["k"], ["x", "y"])) == [("p", 1, 5, "both"), ("q", 2, 3, "first"), ("r", 7, None, "second")]
    once = merge.append_new(a, b, ["k"])
    assert rows(merge.append_new(once, b, ["k"])) == rows(once) == [("p", 1, None), ("q", 2, 3), ("r", 7, None)]
    assert rows(merge.prefer([a, b], ["k"])) == rows(once)
    m = merge.period_matrix(spark.createDataFrame([("s", "P1", 1), ("s", "P2", 2), ("t", "P1", 3)], "k string, p string, v int"), ["k"], "p", "v", ["P1", "P2", "P3"])
    assert rows(m) == [("s", 1, 2, None), ("t", 3, None, None)]
    assert rows(merge.unpivot_matrix(m, ["k"], ["P1", "P2", "P3"], False)) == [("s", "P1", 1), ("s", "P2", 2), ("t", "P1", 3)]
    layout = spark.createDataFrame([("10", "b"), ("9", "a"), ("11", "c")], "row string, k string")
    assert [r.k for r in merge.layout_map(layout, spark.createDataFrame([("a", 1)], "k string, v int"), ["k"], "row").collect()] == ["a", "b", "c"]


def test_similarity(spark):
    vecs = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.1]), (3, [0.0, 1.0]), (4, None), (5, [0.0, 0.0]), (6, [2.0, 0.0])], "vec_id bigint, embedding array<double>")
    top = similarity.top_k(vecs, vecs.where("vec_id = 1"), 2)
    assert [(r.neighbor_id, r.rank) for r in top.orderBy("rank").collect()] == [(6, 1), (2, 2)]
    assert rows(similarity.neighbor_counts(vecs, vecs.where("vec_id in (1, 3)"), 0.9).select("query_id", "n")) == [(1, 2), (3, 0)]
    assert similarity.top_k(vecs, vecs.where("false"), 2).count() == 0


def test_searches_in_blocks(spark, monkeypatch):
    """Blocks, passes and batches of any size give what brute force gives, ties, odd vectors and repeated rows included."""
    import random

    import numpy as np

    rng = random.Random(1)
    data = [(i, [float(rng.randint(-2, 2)) for _ in range(3)]) for i in range(60)] + [(60, None), (61, [0.0] * 3), (62, [1.0, 2.0]), (63, [1.0, 0.0, 0.0]), (64, [1.0, 0.0, 0.0]), (None, [1.0, 1.0, 1.0])]
    df = spark.createDataFrame(data, "vec_id bigint, embedding array<float>").repartition(5)
    asked = df.where("vec_id % 3 = 0")
    unit = {i: (np.array(v) / (np.linalg.norm(v) or 1) if v is not None and len(v) == 3 else np.zeros(3)) for i, v in data if i is not None}
    sim = {(q, i): float(unit[q] @ unit[i]) for q in unit if q % 3 == 0 for i in unit if i != q}
    want = [(q, i, n) for q in unit if q % 3 == 0 for n, i in enumerate(sorted((i for i in unit if i != q), key=lambda i: (-round(sim[q, i], 9), i))[:4], 1)]
    pairs = sorted((q, i) for (q, i), s in sim.items() if s >= 0.9 and (i % 3 or q < i))
    for block, held in ((1024, 64), (4, 2)):
        monkeypatch.setattr(similarity, "QUERY_BLOCK", block)
        monkeypatch.setattr(similarity, "BLOCKS_HELD", held)
        assert sorted((r.query_id, r.neighbor_id, r.rank) for r in similarity.top_k(df, asked, 4).collect()) == sorted(want)
        assert sorted((r.query_id, r.neighbor_id) for r in similarity.similar_pairs(df, asked, 0.9).collect()) == pairs
    kinds = {(r.id, r.kind): r.n for r in similarity.violations(spark.createDataFrame([(1, 2, 0.95), (1, 3, 0.7), (1, 4, 0.8), (5, 6, 0.7)], "query_id bigint, neighbor_id bigint, similarity double"), 0.9).collect()}
    assert kinds == {(1, "pair"): 1, (1, "neighbors"): 2}
    assert similarity.similar_pairs(df, asked.where("false"), 0.9).count() == 0


def test_pca_of_odd_tables(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [2.0, 1.0]), (3, None), (4, []), (5, [3.0, 3.5])], "id int, embedding array<float>")
    reduced, k = similarity.pca(df, variance=0.9)
    assert 1 <= k <= 2 and sorted(r.id for r in reduced.collect()) == [1, 2, 5]
    empty, k = similarity.pca(df.where("false"))
    assert k == 0 and empty.count() == 0 and "reduced" in empty.columns


def test_rule_driven_checks(spark):
    from tallyspan.plans import sheets
    from tallyspan.sources import rules as R

    v = spark.createDataFrame([("d", "a", 10.0), ("d", "b", -4.0), ("d", "c", 6.0), ("e", "a", 1.0), ("e", "c", 9.0), ("f", "z", 1.0)], "doc_id string, field string, value double")
    formulas = R.formula_table(spark, [{"description": "sum", "formula": "c == a + b"}, {"description": "odd", "formula": "a = b"}, {"description": "near", "formula": "c == a", "tolerance": 5}])
    got = {(r.doc_id, r.rule): (r.match, sorted(r.missing)) for r in validate.formula_checks(v, formulas, ["doc_id"]).collect()}
    assert got == {("d", "sum"): (True, []), ("e", "sum"): (True, ["b"]), ("d", "odd"): (True, []), ("e", "odd"): (True, ["b"]), ("d", "near"): (True, []), ("e", "near"): (False, [])}
    pairs = R.pair_table(spark, [{"field_name": "a", "xbrl_key": "A", "display_name": "first"}, {"field_name": "c", "xbrl_key": "C", "tolerance": 3}])
    other = spark.createDataFrame([("d", "A", -10.5), ("e", "C", 20.0), ("g", "A", 5.0)], "doc_id string, field string, value double")
    got = {(r.doc_id, r.rule): (r.source, r.match) for r in validate.pair_checks(v, other, pairs, ["doc_id"]).collect()}
    assert got == {("d", "first"): ("both", True), ("d", "c"): ("pdf_only", True), ("e", "first"): ("pdf_only", True), ("e", "c"): ("both", False), ("g", "first"): ("xbrl_only", True)}
    checks = sheets.checks(v, formulas=formulas, other=other, pairs=pairs)
    report = [(r.part, r.line_no, r.line) for r in reshape.sectioned_report(checks, ["doc_id"], "category", "rule", sheets.CATEGORIES).where("doc_id = 'e'").orderBy("part", "line_no").collect()]
    assert [x[2] for x in report] == ["sum: not run", "formula: 2 passed, 1 failed", "mismatch: near expected 9, found 1, off by 8", "source: not run", "pair: 1 passed, 1 failed", "mismatch: c expected 9, found 20, off by 11", "reference: not run", "2 checks failed"]
    assert validate.formula_checks(v.where("false"), formulas, ["doc_id"]).count() == 0


def test_table_on_the_next_page(spark):
    tables = spark.createDataFrame([("a", 1, 0, "uno dos"), ("a", 2, 0, "uno dos tres"), ("b", 1, 0, "nada"), ("b", 2, 1, "uno dos"), ("b", 2, 0, "uno dos"), ("c", 3, 0, "uno dos"), (None, 1, 0, "uno dos")], "doc string, page_no int, idx int, t string")
    wanted = spark.createDataFrame([("a", 1), ("b", 1), ("c", 1), (None, 1)], "doc string, page_no int")
    assert rows(matching.best_table_or_next(tables, wanted, ["doc"], "page_no", "idx", "t", ["uno", "dos"], least=2)) == [("a", 1, 0, 2), ("b", 2, 0, 2)]
