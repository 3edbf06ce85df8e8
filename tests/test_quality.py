"""Problems 4, 5 and 6 on small cases and against brute force."""

import json
import random
import re
from datetime import datetime

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyspan.operators import badrows as B
from tallyspan.operators import drift
from tallyspan.operators.diff import FieldRule, compare_copies

# --- 5: rows that fail to parse


def split_quoted(text, sep):
    """Fields of a line, or None where quoting is broken: one character at a time."""
    out, i, n = [], 0, len(text)
    while True:
        if i < n and text[i] == '"':
            field, i = "", i + 1
            while True:
                if i >= n:
                    return None
                if text[i] == '"':
                    if i + 1 < n and text[i + 1] == '"':
                        field, i = field + '"', i + 2
                        continue
                    i += 1
                    break
                field, i = field + text[i], i + 1
            if i < n and text[i] != sep:
                return None
        else:
            field = ""
            while i < n and text[i] != sep:
                if text[i] == '"':
                    return None
                field, i = field + text[i], i + 1
        out.append(field)
        if i >= n:
            return out
        i += 1


def reason_of(kind, sep, payload):
    if payload is None or not payload.strip():
        return "column_count"
    fields = split_quoted(payload, sep)
    if fields is None:
        return "quoting"
    if kind not in ("line_item", "source_info") or len(fields) != (5 if kind == "line_item" else 8):
        return "column_count"
    f = [x.strip() for x in fields]
    digits = r"(?:[0-9]+|[0-9]{1,3}(?:\.[0-9]{3})+)"
    ok = f[0] != ""
    if kind == "line_item":
        ok = ok and all(re.fullmatch(rf"|-|-?{digits}|\(\s*{digits}\s*\)", x) for x in f[1:])
    else:
        ok = ok and bool(re.fullmatch(r"[0-9]+(\.[0-9]+)?", f[5])) and 0 <= float(f[5]) <= 1
        m = re.fullmatch(r"([0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2})(\.[0-9]{1,6})?(Z|\+00:00)?", f[6])
        try:
            ok = ok and m is not None and bool(datetime.strptime(m[1], "%Y-%m-%dT%H:%M:%S"))
        except ValueError:
            ok = False
        ok = ok and bool(re.fullmatch(rf"|-|(M?US\$ ?)?(-?{digits}(,[0-9]+)?|\(\s*{digits}(,[0-9]+)?\s*\))", f[7]))
    return None if ok else "value"


def check_lines(spark, lines):
    df = spark.createDataFrame([(i, *x) for i, x in enumerate(lines)], "raw_id int, record_kind string, sep string, payload string")
    got = {r.raw_id: r.reason for r in B.classify(df).collect()}
    want = {i: reason_of(*x) for i, x in enumerate(lines)}
    assert got == want, [(lines[i], got[i], want[i]) for i in got if got[i] != want[i]][:3]
    assert {r.raw_id for r in B.invalid_rows(B.classify(df), ["raw_id"]).collect()} == {i for i, w in want.items() if w}


GOOD = "f;xml;p;l;d;0.9;2024-01-02T03:04:05.25Z;MUS$ (1.234,5)"


def test_lines(spark):
    source = lambda i, v: ";".join([*GOOD.split(";")[:i], v, *GOOD.split(";")[i + 1 :]])
    lines = [("source_info", ";", GOOD)]
    lines += [("source_info", ";", source(5, v)) for v in ("1", "1.0", "1.01", "-0.1", "0,9", "", ".5", "1e-1", '"0.5"', " 0.5 ")]
    lines += [("source_info", ";", source(6, v)) for v in ("2024-02-30T00:00:00", "2024-02-29T23:59:59", "2023-02-29T00:00:00", "2024-01-01T24:00:00", "2024-01-01T00:00:60", "2024-01-01 00:00:00", "2024-01-01T00:00:00.1234567", "2024-01-01T00:00:00+01:00", "")]
    lines += [("source_info", ";", source(7, v)) for v in ("", "-", "5", "US$-5", "US$  5", "MUS$5,5", "(5,5)", "5,", "1.23", "--", "(-5)", "$5", "1.234.567,00")]
    item = lambda *v: ("line_item", "|", "|".join(v))
    lines += [item("a", "1", "-2", "(3)", "( 1.234 )"), item("a", "", "-", "1", "1"), item("", "1", "1", "1", "1"), item("a", "1.23", "1", "1", "1"), item("a", "1", "1", "1"), item("a", "1", "1", "1", "1", "1")]
    lines += [item('"a|b"', "1", "1", "1", "1"), item('"a ""b"" c"', "1", "1", "1", "1"), item('"a', "1", "1", "1", "1"), item('a"b', "1", "1", "1", "1"), item('"a"x', "1", "1", "1", "1"), item(' "a"', "1", "1", "1", "1"), item('""', "1", "1", "1", "1"), item('"a\nb"', "1", "1", "1", "1"), item('"""a"""', '" 5 "', "1", "1", "1")]
    lines += [("line_item", ";", None), ("line_item", ";", ""), ("line_item", "\t", " \t "), ("line_item", None, "a"), ("line_item", "", "a"), (None, ";", "a;1;1;1;1"), ("other", ";", "a;1"), ("line_item", ":", "a:1:2:3:4"), ("line_item", ":", '"a:b":1:2:3:4')]
    lines += [("line_item", ";", "x" * 300_000 + ";1;1;1;1"), ("line_item", ";", '"' + '""' * 100_000 + '";1;1;1;1'), ("line_item", ";", ";" * 100_000), ("line_item", ";", '"' * 99_999)]
    check_lines(spark, lines)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["line_item", "source_info"]), st.sampled_from([";", "|", "\t", ","]), st.text(alphabet='";|\t,a1.-() \n', max_size=14)), min_size=1, max_size=60))
def test_lines_against_brute_force(spark, lines):
    check_lines(spark, lines)


def test_typed_rows(spark):
    df = spark.createDataFrame([(1, "line_item", ";", '"a ""x"" ";(1.234);-;;-5', 7), (2, "source_info", ";", GOOD, 8), (3, "line_item", ";", "bad", 9)], "raw_id int, record_kind string, sep string, payload string, reason int")
    c = B.classify(df)
    assert [tuple(r) for r in B.valid_rows(c, B.LINE_ITEM, ["raw_id"]).collect()] == [(1, 'a "x"', -1234, None, None, -5)]
    r = B.valid_rows(c, B.SOURCE_INFO, ["raw_id"]).first()
    assert (r.raw_value, r.confidence, r.timestamp) == (-1234.5, 0.9, datetime(2024, 1, 2, 3, 4, 5, 250000))
    assert c.where("raw_id = 3").first()._corrupt == "bad"
    assert B.classify(df.where("false")).count() == 0


# --- 6: differences between two copies


def test_compare_copies(spark):
    schema = "k string, v double, t string, b boolean, at int, difference string"
    a = spark.createDataFrame([("x", 1.0, "A ", True, 1, "c"), ("x", 5.0, "old", None, 0, "c"), ("y", -2.0, None, None, 1, "c"), ("only", 1.0, None, None, 1, "c"), (None, 3.0, "n", None, 1, "c"), ("tie", 1.0, "a", None, None, "c"), ("tie", 2.0, "a", None, None, "c")], schema)
    b = spark.createDataFrame([("X", 1.001, "a", False, 1, "d"), ("y", 2.0, " ", None, 1, "d"), (None, None, "n", None, 1, "d"), ("new", None, None, None, None, "d"), ("tie", 2.0, "a", None, None, "d")], schema)
    rules = [FieldRule("v", "magnitude", 0.001), FieldRule("t", "text"), FieldRule("b")]
    run = lambda x, y: compare_copies(x, y, {"k": F.lower("k")}, rules, "at", ("l", "r"))
    got = sorted((tuple(r)[:2] for r in run(a, b).collect()), key=str)
    assert got == sorted([("x", "b"), ("only", "only_l"), (None, "v"), ("new", "only_r")], key=str)
    assert run(a, a).count() == 0
    assert run(a.where("false"), b.where("false")).count() == 0
    assert {r.difference for r in run(a, b.where("false")).collect()} == {"only_l"}


def test_compare_hot_key(spark):
    a = spark.range(20_000).select(F.lit("hot").alias("k"), F.col("id").cast("double").alias("v"), F.col("id").alias("at"))
    b = spark.createDataFrame([("hot", 19_999.0, 1)], "k string, v double, at long")
    assert compare_copies(a, b, {"k": F.col("k")}, [FieldRule("v", "magnitude", 0.0)], "at").count() == 0


# --- 4: schemas that drift


#: Names of one field as learn_names gives them.
GROUPS = {"quarter": "quarter", "trimestre": "quarter", "periodo": "quarter"}


def brute_changes(series, known):
    """Changes of one series, file by file, with the kinds of all fields ever seen."""
    known = drift.Names(known, GROUPS)
    out, last, kinds = [], None, {}
    for file_id, content in series:
        now = drift.profile(content)
        if now is None:
            continue
        if last is not None:
            rows, renames = drift.layout_changes(last, now, known)
            out += [(file_id, *r) for r in rows]
            moved = {n: kinds.get(o) for o, n in renames.items()}
            for o in renames:
                kinds.pop(o, None)
            for n, k in moved.items():
                kinds.pop(n, None)
                if k:
                    kinds[n] = k
        for name, (kind, _) in now["fields"].items():
            if kind and kinds.get(name, kind) != kind:
                out.append((file_id, name, "type_changed", ""))
            if kind:
                kinds[name] = kind
        last = now
    return out


def random_files(seed, n):
    rng = random.Random(seed)
    names = ["quarter", "periodo", "trimestre", "cash_cost", "Cash_Cost", "val_cash_cost", "ebitda", "nota", "non_cash_cost"]
    values = [None, 1, 2.5, "IQ2024", "x", True, [1], {"a": 1}]
    files = []
    for i in range(n):
        record = {k: rng.choice(values) for k in rng.sample(names, rng.randint(1, 6))}
        body = rng.choice([json.dumps(record), json.dumps({"year": 1, "content": record}), json.dumps(record), None, "", "[1]", "{broken"]) if rng.random() < 0.5 else json.dumps(record)
        files.append((i, rng.choice(["a", "a", "a", "b", None]), rng.randint(1, 5), body))
    return files


def test_drift_against_brute_force_in_any_partitioning(spark):
    known = frozenset(("quarter", "cash_cost", "non_cash_cost", "ebitda"))
    for seed in range(3):
        files = random_files(seed, 150)
        df = spark.createDataFrame(files, "file_id bigint, s string, o int, content string").withColumn("change", F.lit("clash"))
        want = []
        for s in ("a", "b", None):
            want += brute_changes([(f[0], f[3]) for f in sorted((f for f in files if f[1] == s), key=lambda f: (f[2], f[0]))], known)
        for parts in (1, 4, 40):
            got = sorted(map(tuple, drift.schema_changes(df, ["s"], [F.col("o")], set(known), parts, GROUPS).collect()))
            assert got == sorted(want), (seed, parts)
    assert drift.schema_changes(df.where("false"), ["s"], [F.col("o")]).count() == 0


def test_drift_changes(spark):
    series = [
        {"quarter": "IQ2024", "v": 1, "n": None}, {"content": {"quarter": "IIQ2024", "v": 1.5, "n": 2}}, {"content": {"trimestre": "IIIQ2024", "v": "3", "n": None}}, {"trimestre": 4, "v": "3", "n": "x", "dotacion": 5},
    ]
    df = spark.createDataFrame([(i, "s", i, json.dumps(r)) for i, r in enumerate(series)], "file_id bigint, s string, o int, content string")
    got = sorted(map(tuple, drift.schema_changes(df, ["s"], [F.col("o")], groups=GROUPS).collect()))
    assert got == [(1, "content", "nested", ""), (2, "quarter", "renamed", "trimestre"), (2, "v", "type_changed", ""), (3, "content", "flattened", ""), (3, "dotacion", "added", ""), (3, "n", "type_changed", ""), (3, "trimestre", "type_changed", "")]


def test_name_likeness_and_assignment():
    same = [("cash_cost", "cashCost"), ("gasto_impuestos", "gast_impu"), ("ebitda", "ebit"), ("x_y", "X-Y"), ("cv_materiales", "cv_materiales_musd"), ("oro_onzas", "val_oro_onzas")]
    assert all(drift.name_likeness(a, b) >= 0.85 for a, b in same)
    assert drift.name_likeness("source", "Fuente", {"source": "source", "fuente": "source"}) == 0.95 and drift.name_likeness("source", "fuente") < 0.6
    assert all(drift.name_likeness(a, b) < 0.6 for a, b in [("source", "quarter"), ("ga_otros", "dotacion"), ("cash_cost", "moneda")])
    number, names = ["number", 5], drift.Names(frozenset(("ebitda", "cash_cost")))
    assert drift.rename_score("val_ebitda", number, "ebitda_monto", number, names) >= drift.RENAMED > drift.rename_score("val_nota", number, "nota_pie", number, names)
    assert drift.assign([[0.9, 0.8], [0.85, 0.0]]) == [(0, 1), (1, 0)]
    assert drift.assign([[0.1], [0.9], [0.2]]) == [(1, 0)] and drift.assign([]) == []


@settings(max_examples=30, deadline=None)
@given(st.integers(1, 4).flatmap(lambda n: st.lists(st.lists(st.floats(0, 1), min_size=n, max_size=n), min_size=1, max_size=4)))
def test_assignment_is_best(score):
    from itertools import permutations

    n, m = len(score), len(score[0])
    best = max(sum(score[i][j] for i, j in zip(range(n), p)) if n <= m else sum(score[i][j] for j, i in zip(range(m), p)) for p in permutations(range(max(n, m)), min(n, m)))
    assert abs(sum(score[i][j] for i, j in drift.assign(score)) - best) < 1e-9


def test_unified(spark):
    df = spark.createDataFrame([(1, "s", '{"Cash_Cost": 5, "periodo": "IQ2024", "extraField": null}'), (2, "s", None), (3, "s", '{"content": {"val_cash_cost": "5"}}')], "file_id bigint, sheet string, content string")
    got = sorted((r.file_id, r.field, r.kind, r.value) for r in drift.unified_rows(df, ["file_id", "sheet"], {"s": {"cash_cost"}}, "sheet", GROUPS).collect() if r.kind)
    assert got == [(1, "cash_cost", "number", "5"), (1, "quarter", "text", '"IQ2024"'), (3, "cash_cost", "text", '"5"')]


def test_names_of_one_field_are_learnt(spark):
    """A name that takes the place of a standing field and its values is one with it; names that only share the values, or are met beside it, aren't."""
    rng, files = random.Random(2), []
    for i in range(120):
        record = {"origin": rng.choice(["site", "portal"]), "flag": rng.random() < 0.5, "stamp": i, "costo": i}
        if i % 10 == 0:
            record["zz"] = record.pop("origin")  # another name of the field
        if i % 12 == 1:
            record["kk"] = record["origin"]  # the same values beside it
        if i % 15 == 2:
            record["yy"] = rng.random() < 0.5
            record.pop("flag")
            record["yy" if i % 30 == 2 else "flag"] = record.pop("yy")  # a flag under another name
        if i % 9 == 3:
            record.pop("stamp")
            record["other"] = f"t{i}"  # takes a place, but not the values
        files.append((json.dumps(record if i % 3 else {"content": record}), "x"))
    files += [(None, "x"), ("", "x"), ("[1]", "x")]
    df = spark.createDataFrame(files, "content string, names string").repartition(3)
    got = drift.learn_names(df, frozenset({"costo"}))
    assert {a: b for a, b in got.items() if a != b} == {"zz": "origin", "yy": "flag"}
    assert {a for a, b in got.items() if a == b} == {"origin", "flag", "stamp"}
    assert drift.learn_names(df.where("false")) == {} and drift.learn_names(df.where("content is null")) == {}
