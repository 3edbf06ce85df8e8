"""Problem 3: distances, trees, mappings."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyspan.llm import canonical, concepts


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        before, row = row, [i]
        for j, d in enumerate(b, 1):
            row.append(min(before[j - 1] + (c != d), before[j] + 1, row[j - 1] + 1))
    return row[-1]


words = st.text(alphabet="abcñ ", max_size=12)


@settings(max_examples=300, deadline=None)
@given(words, words)
def test_distance(a, b):
    assert canonical.Pattern(a).distance(b) == plain_distance(a, b)


@settings(max_examples=100, deadline=None)
@given(st.lists(words, max_size=25, unique=True), words, st.integers(0, 5))
def test_tree_finds_every_entry_within(entries, text, most):
    tree = canonical.BKTree(dict.fromkeys(entries))
    assert tree.within(text, most) == sorted((d, e) for e in entries if (d := plain_distance(text, e)) <= most)


def test_core():
    same = ["  Costo caja C1 por libra ", "a) COSTO CAJA C1 POR LIBRA ......", "12. Costo caja C1 por libra (*)", "• Costo caja C1 por libra -Nota 12", "Costo\xa0caja\nC1 por libra (US$ miles)", "Costo caja C1 por libra MUS$", "C0sto caja C1 por libra:"]
    assert {canonical.core(s) for s in same} == {"costo caja c1 libra"}
    assert canonical.core("") == "" and canonical.core("...") == "" and canonical.core("de la") == "de la"


ENTRIES = [("b", "Consumo de energía eléctrica", "energia", 1), ("b", "Suministro eléctrico", "energia", 1), ("b", "Servicios contratados a terceros", "servicios", 2), ("c", "Servicios contratados a terceros", "otros", 3)]


def mapped(spark, rows, most=canonical.MOST_ENTRIES):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, block string, text string").withColumn("target", F.lit("clash"))
    entries = spark.createDataFrame(ENTRIES, "block string, entry string, target string, order int")
    return {r.id: r.target for r in canonical.map_to_reference(df, "text", ["block"], entries, ["id"], most).collect()}


ROWS = [("b", "consumo energia electrica"), ("b", "Cnosumo de energía eléctrca"), ("b", "Servicios contratados a terce"), ("b", "SUMINISTRO ELECTRICO (1)"), ("c", "servicios contratados a terceros"), ("c", "Suministro eléctrico"), ("b", "Royalty ad valorem"), ("b", None), ("b", ""), ("z", "Suministro eléctrico"), (None, "Suministro eléctrico"), ("b", "x" * 100_000), ("b", "suministro electrico")]
WANT = dict(enumerate(["energia", "energia", "servicios", "energia", "otros", None, None, None, None, None, None, None, "energia"]))


def test_mapping(spark):
    assert mapped(spark, ROWS) == WANT


def test_sharded_equals_broadcast(spark):
    assert mapped(spark, ROWS, most=2) == WANT


def test_empty_tables(spark):
    df = spark.createDataFrame([], "id int, block string, text string")
    entries = spark.createDataFrame(ENTRIES, "block string, entry string, target string, order int")
    assert canonical.map_to_reference(df, "text", ["block"], entries, ["id"]).count() == 0
    one = spark.createDataFrame([(1, "b", "x")], "id int, block string, text string")
    assert canonical.map_to_reference(one, "text", ["block"], entries.where("false"), ["id"]).first().target is None


def test_recall_by_length(spark):
    """Entries with a tenth of their letters changed come back at every length; a tighter tolerance finds fewer."""
    import random

    rng = random.Random(3)
    made = ["".join(rng.choice("bcdfgaeiou ") for _ in range(n)) for n in range(8, 90) for _ in range(3)]
    entries = [(e, e, i) for i, e in enumerate(made) if len(canonical.core(e)) > 7]

    def worn(e):
        for _ in range(max(1, min(6, len(e) // 10))):
            at = rng.randrange(len(e))
            e = e[:at] + "z" + e[at + 1 :]
        return e

    asked = [(e, worn(canonical.core(e))) for e, _, _ in entries]
    found = lambda t, lo, hi: [(m := canonical.Matcher(entries, t).best) and (b := m(w)) is not None and b[3] == e for e, w in asked if lo <= len(e) < hi]
    for lo, hi in ((8, 22), (22, 45), (45, 90)):
        right = found(canonical.USUAL, lo, hi)
        assert sum(right) >= 0.97 * len(right)
        assert sum(found(canonical.Tolerance(0.01, 0, 1.0), lo, hi)) < sum(right)


def test_ties_go_to_the_first_entry():
    m = canonical.Matcher([("abcdefgh1x", "late", 2), ("abcdefgh2x", "early", 1)])
    assert m.best("abcdefgh3x")[3] == "early"


def test_labels_and_typos_of_the_rules(spark, data):
    """Each label maps to its own field also with a letter lost, two swapped, or the end cut off."""
    entries = concepts.reference_entries(spark, data)
    labels = spark.read.parquet(f"{data}/field_rule.parquet").select("sheet", "section", "label", "field").collect()
    rows = []
    for r in labels:
        n = len(r.label) // 2
        forms = [r.label.upper(), r.label[:n] + r.label[n + 1 :], r.label[: n - 1] + r.label[n] + r.label[n - 1] + r.label[n + 1 :], r.label[:-2] if len(r.label) > 14 else r.label, f"3. {r.label} .... (US$ miles)"]
        rows += [(r.sheet, r.section, f, r.field) for f in forms]
    df = spark.createDataFrame(rows, "sheet string, section string, concepto string, due string")
    got = canonical.map_to_reference(df, "concepto", ["sheet", "section"], entries, ["due", "concepto"])
    wrong = got.where("target is null or target <> due").collect()
    assert len(wrong) <= 0.01 * len(rows), wrong[:5]
