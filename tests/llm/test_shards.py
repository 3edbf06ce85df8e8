"""Sharded lists answer as one tree does, also where a beginning stands for several targets."""

import pytest

from tallyspan.llm import canonical

# "servicio minero " begins entries of three targets; "gasto de personal " entries of two
ENTRIES = [("b", "Servicio minero externo alfa", "a", 1), ("b", "Servicio minero externo beta", "b", 2), ("b", "Servicio minero externo gama", "c", 3), ("b", "Gasto de personal externo", "d", 4), ("b", "Gasto de personal exterior", "e", 5), ("c", "Servicio minero externo alfa", "f", 6)]
TEXTS = ["Servicio minero externo", "Servicio minero exter", "Servicio minero externo gam", "Servicio minero externo bet", "Gasto de personal ext", "Gasto de personal exteri", "Gasto de personal externo", "Servizio minero externo gam", "nada"]


@pytest.mark.parametrize("at", [0, 2])
@pytest.mark.parametrize("most", [3])
def test_any_order_of_shards(spark, at, most):
    rows = spark.createDataFrame([(b + t, b, t) for b in "bc" for t in TEXTS], "id string, block string, text string")
    entries = spark.createDataFrame([*ENTRIES[at:], *ENTRIES[:at]], "block string, entry string, target string, order int").coalesce(1)
    answers = lambda n: sorted(map(str, canonical.map_to_reference(rows, "text", ["block"], entries, ["id"], n).collect()))
    assert answers(most) == answers(canonical.MOST_ENTRIES)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_lists(spark, seed):
    """Random entries with shared beginnings, null blocks and values, in shards of several sizes and chunks."""
    import random

    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abk") for _ in range(rng.randint(3, 7)))
    heads = [f"{word()} {word()}" for _ in range(4)]
    blocks = ["b", "c", None]
    entries = [(rng.choice(blocks), f"{rng.choice(heads)} {word()}", f"t{rng.randint(0, 5)}", i) for i in range(24)]
    texts = [e[1][: rng.randint(6, len(e[1]))] for e in entries] + [e[1].replace("a", "k", 1) for e in entries] + [None, "", "zzz"]
    rows = spark.createDataFrame([(i, rng.choice(blocks), t) for i, t in enumerate(texts)], "id int, block string, text string")
    listed = spark.createDataFrame(entries, "block string, entry string, target string, order int")
    answers = lambda n, chunk=10: sorted(map(str, canonical.map_to_reference(rows, "text", ["block"], listed, ["id"], n, chunk=chunk).collect()))
    whole = answers(20_000)
    assert answers(20, 1000) == whole and answers(3, 40) == whole and any("target='t" in x for x in whole)
