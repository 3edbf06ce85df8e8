"""Problem 1 on small cases, and against planted units."""

import math
import random

from pyspark.sql import Row
from pyspark.sql import functions as F

from tallyspan.operators import units as U

UNITS = [Row(quantity="money", unit_code="kusd", to_base=1.0, is_base=True), Row(quantity="money", unit_code="usd", to_base=0.001, is_base=False), Row(quantity="money", unit_code="musd", to_base=1000.0, is_base=False)]


def test_weighted_distance():
    assert U.weighted_distance("us$", "us$") == 0
    assert U.weighted_distance("mm lb", "mmlbs") < U.weighted_distance("mm lb", "lb")
    assert U.weighted_distance("lb", "klb") >= 2 and U.weighted_distance("mus$", "mmus$") >= 1
    assert U.weighted_distance("", "ab") == U.weighted_distance("ab", "")


def test_alias_dictionary(spark):
    asked = [("money", "miles de dolares"), ("money", "miles dolares"), ("money", "mm us $"), ("money", "zzz"), ("metal_mass", "libras"), ("metal_mass", "kg."), ("ore_mass", "lb"), ("money", None), ("money", "")]
    df = spark.createDataFrame(asked, "quantity string, spelling string")
    got = {(r.quantity, r.spelling): r.code for r in U.alias_dictionary(df).collect()}
    assert got == {("money", "miles de dolares"): "kusd", ("money", "miles dolares"): "kusd", ("money", "mm us $"): "musd", ("metal_mass", "libras"): "lb", ("metal_mass", "kg."): "kg"}
    assert U.alias_dictionary(df.where("false")).count() == 0


# Spellings as sources write them, to measure the words by; the engine doesn't hold this list.
SPELLINGS = {
    ("metal_mass", "mm_lb"): ("MM lb", "MMlbs", "millones de libras", "million lbs", "million pounds", "mill. lb", "mill. libras"),
    ("metal_mass", "klb"): ("klb", "k lbs", "miles lb", "miles de libras", "thousand pounds", "thousand lbs"),
    ("metal_mass", "lb"): ("lb", "lbs", "libras", "pounds"),
    ("metal_mass", "t"): ("t", "ton", "tons", "tonnes", "toneladas", "ton. métricas", "toneladas métricas", "TM", "TMF", "metric tons"),
    ("metal_mass", "kt"): ("kt", "k ton", "KTM", "KTMF", "miles ton", "miles TM", "miles de toneladas", "thousand tonnes"),
    ("metal_mass", "kg"): ("kg", "kgs", "kilos", "kilogramos", "kilograms"),
    ("metal_mass", "st"): ("st", "short tons", "ton. cortas", "toneladas cortas"),
    ("ore_mass", "t"): ("t", "ton", "tons", "tonnes", "toneladas", "ton. métricas", "toneladas métricas", "TM", "metric tons"),
    ("ore_mass", "kt"): ("kt", "k ton", "KTM", "miles ton", "miles TM", "miles de toneladas", "thousand tonnes"),
    ("ore_mass", "mt"): ("MM ton", "MM t", "MMt", "mill. t", "mill. ton", "millones de toneladas", "million tonnes"),
    ("money", "usd"): ("USD", "US$", "dólares", "US dollars", "us$ enteros", "iso4217:USD", "U_USD"),
    ("money", "kusd"): ("kUSD", "k US$", "MUS$", "M US$", "M USD", "miles US$", "US$ miles", "miles de dólares", "MilesUSD", "USD_miles", "MilesDeDolares", "USDx1000", "thousand dollars"),
    ("money", "musd"): ("MMUS$", "MM US$", "MM USD", "millones US$", "US$ millones", "millones de dólares", "USD_millones", "MillonesUSD", "USDx1000000", "US$ million", "million dollars"),
    ("price", "usd_lb"): ("US$/lb", "USD/lb", "US$ por libra", "dólares/libra", "dólares por libra", "dollars per pound"),
    ("price", "usc_lb"): ("c/lb", "¢/lb", "cUS$/lb", "USc/lb", "centavos/libra", "centavos por libra", "cents per pound"),
    ("price", "usd_t"): ("US$/t", "US$/ton", "USD/t", "USD/TM", "US$ por tonelada", "dólares por tonelada", "dollars per tonne"),
    ("gold_mass", "koz"): ("koz", "k oz", "miles oz", "miles de onzas", "thousand ounces"),
    ("gold_mass", "oz"): ("oz", "onzas", "onzas troy", "ounces", "troy ounces"),
    ("gold_mass", "kg"): ("kg", "kgs", "kilos", "kilogramos", "kilograms"),
}


def mapped(spark, rows, words=None):
    """Share of (quantity, spelling, code) rows that map right, and that map wrong."""
    df = spark.createDataFrame(rows, "quantity string, raw string, due string").withColumn("spelling", U.spelling_key(F.col("raw")))
    got = df.join(U.alias_dictionary(df, words), ["quantity", "spelling"], "left")
    right, wrong = got.agg(F.count_if(F.col("code") == F.col("due")), F.count_if(F.col("code") != F.col("due"))).first()
    return right / len(rows), wrong / len(rows)


ROWS = [(q, s, code) for (q, code), all_ in SPELLINGS.items() for s in all_]


def test_spellings_compose(spark):
    listed = {(q, w) for (q, _), ws in U.unit_words().items() for w in ws}
    assert sum((q, s) not in listed for q, s, _ in ROWS) > 60
    assert mapped(spark, ROWS) == (1.0, 0.0)


def test_held_out_words(spark):
    """With half of the unit words taken away at random more than half of the spellings still map, and next to none wrong; with a letter lost, doubled or swapped nearly all do."""
    shares = []
    for seed in range(3):
        rng = random.Random(seed)
        half = {k: tuple(rng.sample(ws, max(1, len(ws) // 2))) for k, ws in U.unit_words().items()}
        shares.append(mapped(spark, ROWS, half))
    assert min(r for r, _ in shares) >= 0.55 and max(w for _, w in shares) <= 0.03, shares
    rng, typos = random.Random(9), []
    for q, s, code in ROWS:
        if len(s) >= 6 and (places := [i for i in range(1, len(s) - 1) if s[i].isalpha() and s[i + 1].isalpha() and s[i].islower()]):
            i = rng.choice(places)
            typos.append((q, rng.choice([s[:i] + s[i + 1 :], s[:i] + s[i] + s[i:], s[:i] + s[i + 1] + s[i] + s[i + 2 :]]), code))
    right, wrong = mapped(spark, typos)
    assert right >= 0.88 and wrong <= 0.03, (right, wrong)


def test_index_finds_what_all_pairs_find(spark):
    """The n-gram index loses no word within the distance: every part against every word of its domain."""
    rng = random.Random(4)
    words = U.unit_words()
    parts = {(q, "".join(c for c in w.lower() if rng.random() > 0.15)) for (q, _), ws in words.items() for w in ws}
    df = spark.createDataFrame(sorted(parts), "domain string, part string").withColumn("part", U.spelling_key(F.col("part"))).where("part is not null")
    seeds = spark.createDataFrame([(q, m, w) for (q, m), ws in words.items() for w in ws], "domain string, meaning string, word string").withColumn("word", U.spelling_key(F.col("word")))
    exact = {(p.domain, p.part, s.meaning) for p in df.collect() for s in seeds.collect() if p.domain == s.domain and U.weighted_distance(p.part, s.word) / max(len(p.part), len(s.word)) <= U.MOST_APART}
    assert {(r.domain, r.part, r.meaning) for r in U._nearest_words(df, words).collect()} == exact


def test_number_readings(spark):
    cases = ["1.234,5", "1,234.5", "1.234.567", "1.234", "1,234", "12.34", "MUS$ 45.811", "9", "", None, "x"]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, t string").orderBy("i")
    first, other = U.number_readings(F.col("t"), point_first=False)
    assert [tuple(r) for r in df.select(first, other).collect()] == [(1234.5, None), (1234.5, None), (1234567.0, None), (1234.0, 1.234), (1.234, 1234.0), (12.34, None), (45811.0, 45.811), (9.0, None), (None, None), (None, None), (None, None)]
    point, _ = U.number_readings(F.col("t"), point_first=True)
    assert [r[0] for r in df.select(point).collect()][3] == 1.234


def test_said(one):
    assert one(["45,5 MM lb", "kUSD 12.000", "12", "(5) t", None, ""], U.said_in_text) == ["mm lb", "kusd", None, "t", None, None]
    assert one(["Cobre fino [MM lb]", "COBRE FINO, en kt", "cobre fino MUS$", "Cobre fino", None, "Otro (kg)"], lambda c: U.said_in_label(c, F.lit("Cobre fino"))) == ["mm lb", "kt", "mus$", None, None, "kg"]


def test_true_units_finds_planted(spark):
    random.seed(7)
    rows, planted = [], {}
    i = 0
    for s in range(25):
        size = random.uniform(2, 5)
        for f, base in (("sales", 0.0), ("cost", -0.2), ("tax", -1.0)):
            for q in (1, 2, 3, 4):
                kusd = 10 ** (size + base + random.gauss(0, 0.05)) * q
                code = random.choice(["kusd"] * 8 + ["usd", "musd"])
                said = random.choice([code, code, None, "kusd" if random.random() < 0.3 else code])
                n = kusd / {"kusd": 1, "usd": 0.001, "musd": 1000}[code]
                rows.append((i, f"S{s}", f, True, "money", said, "kusd", n, None, float(q)))
                planted[i] = code
                i += 1
    rows.append((i, "S0", "sales", True, "money", "musd", "kusd", 0.0, None, 1.0))
    rows.append((i + 1, None, "sales", True, "money", None, "kusd", None, None, 1.0))
    df = spark.createDataFrame(rows, "id int, segment string, fkey string, scales boolean, quantity string, stated string, usual string, first double, other double, spread double")
    got = {r.id: r.unit_code for r in U.true_units(df, UNITS).collect()}
    assert {k: v for k, v in got.items() if k in planted} == planted
    assert got[i] == "musd" and got[i + 1] is None
    assert U.true_units(df.where("false"), UNITS).count() == 0


def test_log_factor(spark):
    r = spark.range(1).select(U.log_factor(F.lit("money"), F.lit("usd"), UNITS), U.log_factor(F.lit("money"), F.lit("?"), UNITS)).first()
    assert math.isclose(r[0], -3) and r[1] is None
