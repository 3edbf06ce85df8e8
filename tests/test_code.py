"""Functions of program texts, packed vectors, split proposals, and the command line."""

from pyspark.sql import functions as F

from tallyspan import __main__ as command
from tallyspan.functions import vectors
from tallyspan.operators import similarity
from tallyspan.sources import code

SOURCE = '''
import os

@decorated
def outer(a, b=1):
    """Says what.

    Says what.
    """
    # a remark
    if a and b:
        for x in [i for i in a if i]:
            print(x)
    elif b:
        return 1
    else:
        def inner():
            return 2
    return a

class C:
    async def short(self): pass
'''


def test_functions(spark, tmp_path):
    (tmp_path / "m.py").write_text(SOURCE)
    (tmp_path / "broken.py").write_text("def (")
    (tmp_path / "empty.py").write_text("")
    got = {r.name: r for r in code.read_functions(spark, str(tmp_path)).collect()}
    assert set(got) == {"outer", "inner", "short"}
    outer = got["outer"]
    assert (outer.doc_id, outer.start_line, outer.loc) == ("m", 4, 16) and outer.text.startswith("@decorated")
    assert outer.told == "outer(a, b)\nSays what.\na remark"
    assert outer.cyclomatic == 7 and got["short"].cyclomatic == 1 and got["short"].cognitive == 0
    assert outer.cognitive == 1 + 1 + 2 + 1 + 1  # if, and, nested for, elif, else
    assert {r.name for r in code.read_functions(spark, str(tmp_path), least=3).collect()} == {"outer"}


def test_packed_vectors(spark):
    df = spark.createDataFrame([(1, [1.5, -2.0]), (2, []), (3, None)], "id int, v array<float>")
    back = df.select("id", vectors.unpacked(vectors.packed(F.col("v"))).alias("v"))
    assert {r.id: r.v for r in back.collect()} == {1: [1.5, -2.0], 2: [], 3: None}
    assert spark.createDataFrame([("no base64!",)], "t string").select(vectors.unpacked(F.col("t")).alias("v")).first().v is None


def test_split_proposal(spark):
    rows = [(f"a{i}", [1.0, 0.1 * i, 0.0]) for i in range(4)] + [(f"b{i}", [-1.0, 0.0, 0.1 * i]) for i in range(3)] + [("c", None)]
    df = spark.createDataFrame(rows, "name string, embedding array<float>")
    assert sorted(r.names for r in similarity.split_proposal(df, "name").collect()) == [["a0", "a1", "a2", "a3"], ["b0", "b1", "b2"]]
    assert [r.names for r in similarity.split_proposal(df.where("name = 'a0'"), "name").collect()] == [["a0"]]
    assert similarity.split_proposal(df.where("false"), "name").count() == 0


def test_command(spark, data, tmp_path, capsys):
    assert command.main(["list"], spark) == 0 and "note_checks" in capsys.readouterr().out
    assert command.main(["nothing", data], spark) == 2
    assert command.main(["units_distinct", data, str(tmp_path / "u.csv")], spark) == 0
    assert spark.read.option("header", True).csv(str(tmp_path / "u.csv")).count() > 0
    assert command.main(["check_report", data, "--report"], spark) == 0 and "all checks passed" in capsys.readouterr().out
