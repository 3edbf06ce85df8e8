"""Problem 1: one quantity recorded in different units and scales.

Three steps. (1) The distinct spellings of units found in any column are mapped
to unit codes. A spelling is a word for a unit with or without a word for its
scale, in front or behind, apart or grown together; both parts are looked up
on their own, so that combinations nobody listed compose. An inverted index of
character n-grams over the words gives candidates, a weighted edit distance
verifies them, and the resulting alias dictionary is joined to all rows. (2) Sizes are modelled as the sum of a
field effect and a segment effect on a log scale, both medians over all rows,
kept as mergeable quantile sketches. (3) A row keeps the unit it states where
its size allows; otherwise the unit whose size fits best is taken.

Spellings are aggregated before the shuffle, so their number and not the
number of rows counts; sketches merge map-side, so a segment with a third of
all rows is no hot spot.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspan.functions.text import strip_accents
from tallyspan.session import written
from tallyspan.sources.tables import broadcast_if_small, settled_if_small

# Words for plain units of mass, of money, and for scales by their power of ten.
_TONNE = ("t", "ton", "tons", "tonnes", "toneladas", "ton métricas", "toneladas métricas", "metric tons", "TM", "TMF")
_KILOGRAM = ("kg", "kgs", "kilos", "kilogramos", "kilograms")
UNIT_WORDS: dict[tuple[str, str], tuple[str, ...]] = {
    ("metal_mass", "lb"): ("lb", "lbs", "libras", "pounds"),
    ("metal_mass", "t"): _TONNE,
    ("metal_mass", "kg"): _KILOGRAM,
    ("metal_mass", "st"): ("st", "short tons", "ton cortas", "toneladas cortas"),
    ("ore_mass", "t"): _TONNE,
    ("money", "usd"): ("USD", "US$", "dólares", "dollars", "US dollars", "US$ enteros", "iso4217:USD", "U_USD"),
    ("gold_mass", "oz"): ("oz", "onzas", "ounces", "onzas troy", "troy ounces"),
    ("gold_mass", "kg"): _KILOGRAM,
}
SCALE_WORDS: dict[int, tuple[str, ...]] = {3: ("k", "m", "mil", "miles", "thousand", "thousands", "x1000"), 6: ("mm", "mill", "millones", "million", "millions", "x1000000")}
# Words of a price, which is a coin per mass.
_COINS = {"usd": ("US$", "USD", "dólares", "dollars"), "usc": ("c", "¢", "cUS$", "USc", "centavos", "cents")}
_PER = ("/", " por ", " per ")
_MASSES = {"lb": ("lb", "libra", "pound"), "t": ("t", "ton", "TM", "tonelada", "tonne")}
# Codes by quantity, plain unit and power of ten.
CODES: dict[tuple[str, str, int], str] = {
    ("metal_mass", "lb", 0): "lb", ("metal_mass", "lb", 3): "klb", ("metal_mass", "lb", 6): "mm_lb", ("metal_mass", "t", 0): "t", ("metal_mass", "t", 3): "kt", ("metal_mass", "kg", 0): "kg", ("metal_mass", "st", 0): "st",
    ("ore_mass", "t", 0): "t", ("ore_mass", "t", 3): "kt", ("ore_mass", "t", 6): "mt",
    ("money", "usd", 0): "usd", ("money", "usd", 3): "kusd", ("money", "usd", 6): "musd",
    ("price", "usd_lb", 0): "usd_lb", ("price", "usc_lb", 0): "usc_lb", ("price", "usd_t", 0): "usd_t",
    ("gold_mass", "oz", 0): "oz", ("gold_mass", "oz", 3): "koz", ("gold_mass", "kg", 0): "kg",
}


def unit_words() -> dict[tuple[str, str], tuple[str, ...]]:
    """UNIT_WORDS and the prices that coins and masses make."""
    prices: dict[tuple[str, str], tuple[str, ...]] = {}
    for coin, coins in _COINS.items():
        for mass, masses in _MASSES.items():
            if ("price", f"{coin}_{mass}", 0) in CODES:
                prices["price", f"{coin}_{mass}"] = tuple(c + p + m for c in coins for p in _PER for m in masses)
    return UNIT_WORDS | prices


#: Share of the longer text that a spelling may differ by, in weighted edits.
MOST_APART = 0.3
#: Decades by which a figure may differ from its expected size.
SIZE_TOLERANCE = 0.5
#: Segments whose medians are sent to every task at most.
SEGMENTS = 200_000
#: Decades added for units that aren't decimal multiples, which seldom stay unsaid.
ODD_UNIT = 0.12

_LOOSE, _SCALE, _MARKS = set(" .-_:,"), set("kmc"), set("$/¢0123456789")


def spelling_key(c: Column) -> Column:
    """Lower case without accents, brackets and outer blanks; the empty text becomes null."""
    plain = F.lower(strip_accents(c))
    plain = F.regexp_replace(plain, r"[\[\](){}]", " ")
    return F.nullif(F.trim(F.regexp_replace(plain, r"(?U)\s+", " ")), F.lit(""))


def _weight(ch: str, starts: bool) -> float:
    if ch in _LOOSE:
        return 0.15
    if ch in _MARKS:
        return 2.0
    if ch in _SCALE and starts:
        return 2.0
    if ch == "s":
        return 0.3
    return 0.5 if ch in "aeiou" else 1.0


def weighted_distance(a: str, b: str) -> float:
    """Edit distance where blanks, dots and plurals are cheap and a leading scale letter, a digit or a currency mark is dear."""
    wa = [_weight(c, i == 0 or a[i - 1] in _LOOSE) for i, c in enumerate(a)]
    wb = [_weight(c, i == 0 or b[i - 1] in _LOOSE) for i, c in enumerate(b)]
    row = [0.0]
    for w in wb:
        row.append(row[-1] + w)
    for i, c in enumerate(a):
        before, row = row, [row[0] + wa[i]]
        for j, d in enumerate(b):
            change = 0.0 if c == d else max(wa[i], wb[j]) if (c in _LOOSE) == (d in _LOOSE) else wa[i] + wb[j]
            row.append(min(before[j] + change, before[j + 1] + wa[i], row[j] + wb[j]))
    return row[-1]


def _grams(c: Column) -> Column:
    """Distinct padded character bigrams of a key, blanks and dots aside."""
    padded = F.concat(F.lit("^"), F.regexp_replace(c, r"[ .\-_:,]", ""), F.lit("$"))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(padded) - 1), lambda i: F.substr(padded, i, F.lit(2))))


def _apart(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for a, b in pairs:
        yield pd.Series([weighted_distance(x, y) / max(len(x), len(y), 1) for x, y in zip(a, b)], dtype="float64")


_SCALE_DOMAIN = "*"


def _nearest_words(asked: DataFrame, words: dict[tuple[str, str], tuple[str, ...]]) -> DataFrame:
    """``(domain, part, meaning, off)``: for each asked part every meaning of its domain that a word within MOST_APART of it has, by the least weighted edits.

    Candidates are the words that share an n-gram with the part, through an
    inverted index.
    """
    rows = [(d, meaning, w) for (d, meaning), all_ in words.items() for w in all_]
    seeds = asked.sparkSession.createDataFrame(rows, "domain string, meaning string, word string").withColumn("word", spelling_key(F.col("word"))).distinct()
    index = broadcast_if_small(seeds.select("domain", "meaning", "word", F.explode(_grams(F.col("word"))).alias("gram")))
    grams = asked.where("part <> ''").distinct().select("domain", "part", F.explode(_grams(F.col("part"))).alias("gram"))
    candidates = grams.join(index, ["domain", "gram"]).select("domain", "part", "meaning", "word").distinct()
    near = candidates.withColumn("apart", F.pandas_udf(_apart, "double")("part", "word")).where(F.col("apart") <= MOST_APART)
    # a short word for a scale is an abbreviation, whose letters all count
    near = near.where((F.col("domain") != _SCALE_DOMAIN) | (F.length("word") > 4) | (F.col("apart") == 0))
    off = F.col("apart") * F.greatest(F.length("part"), F.length("word"))
    return near.groupBy("domain", "part", "meaning").agg(F.min(off).alias("off"))


def _parses(c: Column) -> Column:
    """Ways to read a spelling as ``(scale, unit)``: all of it a unit, its first or last word a scale, or a scale word grown together with the unit. A ``de`` or ``of`` between them doesn't count."""
    start, end = r"^[ ._\-]*(?:de |of |de(?=dol|us|lib|ton|onz))?[ ._\-]*", r"[ ._\-]+$"
    made = lambda scale, unit: F.struct(scale.alias("scale"), F.regexp_replace(F.regexp_replace(unit, start, ""), end, "").alias("unit"))
    first, last = r"^([^ ._]+)[ ._]+", r"[ ._]+([^ ._]+)\.?$"
    ways = [
        F.struct(F.lit("").alias("scale"), c.alias("unit")),
        F.when(c.rlike(first), made(F.regexp_extract(c, first, 1), F.regexp_replace(c, first, ""))),
        F.when(c.rlike(last), made(F.regexp_extract(c, last, 1), F.regexp_replace(c, last, ""))),
    ]
    for word in sorted({w for all_ in SCALE_WORDS.values() for w in all_}):
        n = len(word)
        if not word.startswith("x"):
            # a word that goes on, with more words behind it, isn't grown together with its unit
            alone = ~c.rlike(rf"^{word}[a-z]+[ .]") if n > 2 else F.lit(True)
            ways.append(F.when(c.startswith(word) & (F.length(c) > n) & alone, made(F.lit(word), F.substr(c, F.lit(n + 1), F.length(c)))))
        if n > 2:
            ways.append(F.when(c.endswith(word) & (F.length(c) > n), made(F.lit(word), F.substr(c, F.lit(1), F.length(c) - n))))
    return F.array_compact(F.array(*ways))


def alias_dictionary(spellings: DataFrame, words: dict[tuple[str, str], tuple[str, ...]] | None = None, scales: dict[int, tuple[str, ...]] | None = None) -> DataFrame:
    """``(quantity, spelling, code, apart)`` for each distinct spelling that words for units and scales explain.

    ``spellings`` has ``quantity`` and ``spelling`` (as spelling_key gives
    it). Of the ways to read a spelling the one with the fewest weighted edits
    counts, ``apart`` being their share of its length; among equals the first
    code by name. Spellings that no words come within MOST_APART of, and scales
    for which a unit has no code, are left out.
    """
    spark = spellings.sparkSession
    known = words or unit_words()
    by_scale = {(_SCALE_DOMAIN, str(power)): ws for power, ws in (scales or SCALE_WORDS).items()}
    asked = spellings.select("quantity", "spelling").where("spelling is not null").distinct()
    read = written(asked.select("quantity", "spelling", F.inline(_parses(F.col("spelling")))).distinct(), "unit-parses")
    parts = read.select(F.col("quantity").alias("domain"), F.col("unit").alias("part")).unionByName(read.select(F.lit(_SCALE_DOMAIN).alias("domain"), F.col("scale").alias("part")))
    near = written(_nearest_words(parts, known | by_scale), "unit-words")
    units = near.where(F.col("domain") != _SCALE_DOMAIN).select(F.col("domain").alias("quantity"), F.col("part").alias("unit"), F.col("meaning").alias("plain"), F.col("off").alias("u"))
    powers = near.where(F.col("domain") == _SCALE_DOMAIN).select(F.col("part").alias("scale"), F.col("meaning").cast("int").alias("power"), F.col("off").alias("s"))
    plain_scale = spark.createDataFrame([("", 0, 0.0)], "scale string, power int, s double")
    codes = F.broadcast(spark.createDataFrame([(*k, c) for k, c in CODES.items()], "quantity string, plain string, power int, code string"))
    meant = read.join(units, ["quantity", "unit"]).join(powers.unionByName(plain_scale), "scale").join(codes, ["quantity", "plain", "power"])
    apart = (F.col("u") + F.col("s")) / F.greatest(F.length("spelling"), F.lit(1))
    best = meant.select("quantity", "spelling", "code", apart.alias("apart")).where(F.col("apart") <= MOST_APART)
    return best.groupBy("quantity", "spelling").agg(F.min(F.struct("apart", "code")).alias("b")).select("quantity", "spelling", "b.code", "b.apart")


_NUMBER = r"[0-9][0-9.,]*[0-9]|[0-9]"


def number_readings(text: Column, point_first: bool) -> tuple[Column, Column]:
    """The likely reading of the first number in a text, and the other one if the text allows two.

    With both marks the last is the decimal one; a repeated mark groups
    thousands; a single mark before exactly three digits is ambiguous: the
    point groups thousands and the comma marks decimals, unless
    ``point_first`` says that the point marks decimals.
    """
    return readings_of(number_token(text), point_first)


def number_token(text: Column) -> Column:
    """The first number of a text as it is written; empty if there is none."""
    return F.regexp_extract(text, _NUMBER, 0)


def readings_of(s: Column, point_first: bool) -> tuple[Column, Column]:
    """number_readings of a token that is already cut out, best a column of its own, as it is used many times."""
    dots = F.length(s) - F.length(F.replace(s, F.lit("."), F.lit("")))
    commas = F.length(s) - F.length(F.replace(s, F.lit(","), F.lit("")))
    as_point = F.replace(s, F.lit(","), F.lit("")).try_cast("double")
    as_comma = F.replace(F.replace(s, F.lit("."), F.lit("")), F.lit(","), F.lit(".")).try_cast("double")
    digits = F.regexp_replace(s, r"[.,]", "").try_cast("double")
    point_last = F.locate(".", F.reverse(s)) < F.locate(",", F.reverse(s))
    grouped = s.rlike(r"^[0-9]{1,3}[.,][0-9]{3}$")
    whole_first = F.lit(not point_first) & (dots == 1)
    first = (
        F.when((dots > 0) & (commas > 0), F.when(point_last, as_point).otherwise(as_comma))
        .when((dots > 1) | (commas > 1), digits)
        .when(grouped & whole_first, digits)
        .when(dots == 1, as_point)
        .otherwise(as_comma)
    )
    other = F.when(grouped & whole_first, as_point).when(grouped, digits)
    return first, other


def text_rest(c: Column) -> Column:
    """A reading's text without its first number, as it is written; null where only figures are left."""
    return F.when(c.rlike(r"[^0-9.,()\s\-]"), F.regexp_replace(c, rf"[-(]?\s*(?:{_NUMBER})", " "))


def said_in_text(c: Column) -> Column:
    """What a reading's text says besides its first number."""
    return spelling_key(text_rest(c))


def said_in_label(label: Column, rule_label: Column) -> Column:
    """What a label says after the field's own label: in brackets, after ``, en`` or at the end. A label that is just the field's own says nothing."""
    plain, own = F.lower(strip_accents(F.trim(label))), F.lower(strip_accents(F.trim(rule_label)))
    rest = F.when(F.startswith(plain, own), F.substr(plain, F.length(own) + 1, F.length(plain)))
    bracket = F.nullif(F.regexp_extract(plain, r"[\[(]([^\])]*)[\])]\s*$", 1), F.lit(""))
    after = F.nullif(F.regexp_extract(plain, r",\s*en\s+(.*)$", 1), F.lit(""))
    return F.when(F.lower(label) != F.lower(rule_label), spelling_key(F.regexp_replace(F.coalesce(rest, bracket, after), r"^\s*,?\s*(?:en\s+)?", "")))


_APART = "\u0001"


def label_pair(label: Column, rule_label: Column) -> Column:
    """A label with the field's own, to be taken apart by said_in_pair; null where they are the same."""
    return F.when(F.lower(label) != F.lower(rule_label), F.concat_ws(_APART, label, rule_label))


def said_in_pair(pair: Column) -> Column:
    parts = F.split(pair, _APART)
    return said_in_label(F.get(parts, F.lit(0)), F.get(parts, F.lit(1)))


def stated_texts(rows: DataFrame, said: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """``(quantity, source, raw, n, spelling)``: the distinct texts of the columns that may state a unit, counted, with the spelling each says.

    Texts are aggregated as they stand, so the spelling is worked out once per
    distinct text and not once per row. A written table, as it is small and
    used twice.
    """
    counted = [
        rows.where(F.col(c).isNotNull()).groupBy("quantity", F.col(c).alias("raw")).agg(F.count("*").alias("n")).select("quantity", F.lit(c).alias("source"), "raw", "n", key(F.col("raw")).alias("spelling"))
        for c, key in said.items()
    ]
    return written(reduce(DataFrame.unionByName, counted).where("spelling is not null"), "unit-texts")


def resolve_stated(rows: DataFrame, said: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """``stated``: the code of the first of the ``said`` columns that the alias dictionary knows for the row's quantity.

    ``said`` maps a column of texts to the expression that finds the spelling
    in one. The dictionary is joined to all rows on the texts as they stand,
    once per column, broadcast while its checked size allows.
    """
    texts = stated_texts(rows, said)
    aliases = broadcast_if_small(written(texts.join(alias_dictionary(texts), ["quantity", "spelling"]).select("quantity", "source", "raw", "code"), "unit-aliases"))
    for i, c in enumerate(said):
        part = aliases.where(F.col("source") == c).select(F.col("quantity").alias("__q"), F.col("raw").alias("__s"), F.col("code").alias(f"__said{i}"))
        rows = rows.join(part, (F.col("quantity") == F.col("__q")) & (F.col(c) == F.col("__s")), "left").drop("__q", "__s")
    return rows.withColumn("stated", F.coalesce(*[F.col(f"__said{i}") for i in range(len(said))])).drop(*[f"__said{i}" for i in range(len(said))])


def log_factor(quantity: Column, code: Column, units: list) -> Column:
    """Log10 of a unit's value in its quantity's base unit; null for an unknown pair."""
    table = F.create_map(*[x for u in units for x in (F.lit(f"{u.quantity} {u.unit_code}"), F.lit(float(u.to_base)))])
    return F.log10(F.try_element_at(table, F.concat_ws(" ", quantity, code)))


def expected_sizes(rows: DataFrame) -> DataFrame:
    """``rows`` with ``expected``: log10 of the size usual for the row's field and segment.

    ``rows`` has ``segment``, ``fkey``, ``scales`` (whether the field grows
    with the segment) and ``size``, log10 of the figure in the base unit. The
    field effect is the median over all rows; the segment effect is the median
    of what remains over the segment's fields that scale; each is refined
    once. Sketches replace exact medians (relative rank error 1/1000).
    """
    fields = lambda d, v: settled_if_small(d.groupBy("fkey").agg(F.percentile_approx(v, 0.5, 1000).alias("f")))
    # a written table of one row per segment, sent to all tasks up to a checked size, so that the rows themselves aren't shuffled; beyond it a skewed join is split by the adaptive plan
    segments = lambda d: broadcast_if_small(written(d.where("scales").groupBy("segment").agg(F.percentile_approx(F.col("size") - F.col("f"), 0.5, 1000).alias("g")), "unit-segments"), SEGMENTS)
    seen = rows.where("size is not null").select("segment", "fkey", "scales", "size")
    first = fields(seen, F.col("size"))
    by_segment = segments(seen.join(first, "fkey"))
    effect = F.when(F.col("scales"), F.coalesce("g", F.lit(0.0))).otherwise(0.0)
    second = fields(seen.join(by_segment, "segment", "left"), F.col("size") - effect)
    final = segments(seen.join(second, "fkey"))
    return rows.join(second, "fkey", "left").join(final, "segment", "left").withColumn("expected", F.col("f") + effect).drop("f", "g")


def true_units(rows: DataFrame, units: list) -> DataFrame:
    """``rows`` with ``unit_code`` and ``how``: ``stated``, ``size`` or ``default``.

    ``rows`` has ``quantity``, ``stated``, ``usual`` (the code where nothing
    else is known), ``first`` and ``other`` (readings of the figure, absolute),
    ``spread`` (periods the figure adds up, 1 at least), ``segment``, ``fkey``
    and ``scales``. A zero figure keeps its stated or usual unit; a null one
    gives no code. The sizes are a written table, of which the medians read
    four columns several times.
    """
    size = lambda n, code: F.log10(F.nullif(n, F.lit(0.0)) / F.col("spread")) + log_factor(F.col("quantity"), code, units)
    rows = expected_sizes(written(rows.withColumn("size", size(F.col("first"), F.coalesce("stated", "usual"))), "unit-sizes"))
    options = []
    for q in sorted({u.quantity for u in units}):
        base = [u for u in units if u.quantity == q]
        odd = lambda u: ODD_UNIT if abs((x := _log(u.to_base)) - round(x)) > 1e-6 and q != "price" else 0.0
        options.append((q, F.array(*[F.struct(F.lit(u.unit_code).alias("code"), F.lit(_log(u.to_base)).alias("f"), F.lit(odd(u)).alias("odd")) for u in base])))
    choice = reduce(lambda acc, o: acc.when(F.col("quantity") == o[0], o[1]), options[1:], F.when(F.col("quantity") == options[0][0], options[0][1]))
    off = lambda n, code: F.abs(size(n, code) - F.col("expected"))
    fits = lambda n: F.coalesce(off(F.col(n), F.col("stated")) <= SIZE_TOLERANCE, F.lit(False))
    raw = lambda n: F.log10(F.nullif(F.col(n), F.lit(0.0)) / F.col("spread"))
    scored = lambda n, extra: F.transform(choice, lambda u: F.struct((F.abs(raw(n) + u["f"] - F.col("expected")) + u["odd"] + F.lit(extra)).alias("s"), u["code"].alias("code")))
    best = F.array_min(F.filter(F.concat(scored("first", 0.0), F.coalesce(scored("other", 0.01), F.array().cast("array<struct<s:double,code:string>>"))), lambda x: x["s"].isNotNull()))
    usual = F.coalesce("stated", "usual")
    said = F.col("stated").isNotNull() & (F.col("expected").isNull() | F.col("size").isNull() | fits("first") | fits("other"))
    return (
        rows.withColumn("__best", best)
        .withColumn("how", F.when(F.col("first").isNull(), None).when(said, "stated").when(F.col("__best").isNull(), "default").otherwise("size"))
        .withColumn("unit_code", F.when(F.col("how").isin("stated", "default"), usual).when(F.col("how") == "size", F.col("__best.code")))
        .drop("__best")
    )


def _log(x: float) -> float:
    import math

    return math.log10(x)
