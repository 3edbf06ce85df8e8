"""Problem 3: mapping freely typed values to the entries of a reference list.

A BK-tree per block (here a sheet and section) holds the reference entries
under the Levenshtein distance, a true metric, so that the triangle inequality
prunes whole subtrees and every entry within the threshold comes back. Lists
up to ``MOST_ENTRIES`` are broadcast; of longer ones the entries and their
beginnings are settled over the whole list and cut into shards of that size,
each shard answers every chunk of the distinct values in one distributed job,
and the shards' winners merge by distance. A task looks up each distinct value
once.

Values are normalised before the distance is taken (case, accents, numbering,
notes, units, letters read as digits, short connecting words), and forms that
were cut off are compared with the entries' own beginnings in a second tree.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspan.session import ship_package, written

#: Entries of one broadcast tree, and about as many of a shard.
MOST_ENTRIES = 20_000
#: Distinct values that meet a shard in one group.
CHUNK = 50_000


@dataclass(frozen=True)
class Tolerance:
    """How far a value may be from an entry: edits allowed per character and at most, and for cut-off forms the least share of the entry that must be kept, the least length of a beginning, and its edits."""

    per_character: float = 0.28
    most_edits: int = 6
    kept_share: float = 0.55
    least_beginning: int = 4
    beginning_edits: int = 2

    def edits(self, text: str) -> int:
        return min(self.most_edits, int(len(text) * self.per_character))


USUAL = Tolerance()
#: Values that a task remembers before it forgets all.
REMEMBERED = 200_000

# Connecting words that carry no meaning of their own.
CONNECTING = frozenset("a al and at by con de del e el en for in la las lo los of on por the to x y".split())

_BULLET = re.compile(r"^(?:[-–—•*·▪]+\s*|\(?[0-9]{1,2}[.)]\s+|\(?[a-z]\)\s*)+")
_UNIT = r"(?:m{0,2} ?us ?\$|us ?\$ ?(?:miles|millones)?|(?:miles|millones)(?: de)? ?(?:us ?\$|dolares)|[mk]{0,2} ?usd)"
_TAIL = re.compile(rf"(?:\s*(?:\.{{2,}}|…+|:|\*+|\((?:\*+|[0-9]{{1,2}}|[a-z])\)|[-–(]?\s*(?:nota|note) ?[0-9]+\)?|[\[(][^\])]*us ?[d$][^\])]*[\])]?|(?<=\s){_UNIT}|-)\s*)+$")
_DIGIT_READ = str.maketrans("0156", "olso")


def fold(text: str) -> str:
    """Lower case, no accents, single blanks."""
    plain = unicodedata.normalize("NFKD", text.lower())
    return re.sub(r"\s+", " ", "".join(c for c in plain if not unicodedata.combining(c))).strip()


def undecorated(text: str) -> str:
    """Folded text without list marks in front and without dot leaders, note references and units behind."""
    s = _BULLET.sub("", fold(text))
    return _TAIL.sub("", s).strip()


def core(text: str) -> str:
    """What is compared: the words of the undecorated text, digits inside words read as letters, connecting words dropped."""
    words = re.findall(r"[^\W_]+", undecorated(text))
    read = [w.translate(_DIGIT_READ) if len(w) > 2 and sum(c.isalpha() for c in w) > sum(c.isdigit() for c in w) else w for w in words]
    return " ".join([w for w in read if w not in CONNECTING] or read)


class Pattern:
    """A text prepared for bit-parallel Levenshtein distances to others."""

    def __init__(self, text: str):
        self.size, self.bits = len(text), {}
        for i, c in enumerate(text):
            self.bits[c] = self.bits.get(c, 0) | 1 << i
        self.full, self.top = (1 << len(text)) - 1, 1 << max(0, len(text) - 1)

    def distance(self, other: str) -> int:
        if not self.size:
            return len(other)
        up, down, score, bits, full, top = self.full, 0, self.size, self.bits, self.full, self.top
        for c in other:
            eq = bits.get(c, 0)
            across = (((eq & up) + up) ^ up) | eq | down
            gain, loss = down | ~(across | up) & full, up & across
            if gain & top:
                score += 1
            elif loss & top:
                score -= 1
            gain, loss = (gain << 1 | 1) & full, (loss << 1) & full
            step = eq | down
            up, down = loss | ~(step | gain) & full, gain & step
        return score


class BKTree:
    """Entries under the Levenshtein distance; ``within`` returns every entry up to a distance."""

    def __init__(self, entries: dict[str, object]):
        self.value = entries
        texts = iter(entries)
        self.root = next(texts, None)
        self.children: dict[str, dict[int, str]] = {t: {} for t in entries}
        for t in texts:
            pattern, at = Pattern(t), self.root
            while True:
                d = pattern.distance(at)
                below = self.children[at].get(d)
                if below is None:
                    self.children[at][d] = t
                    break
                at = below

    def within(self, text: str, most: int) -> list[tuple[int, str]]:
        if self.root is None:
            return []
        pattern, found, todo = Pattern(text), [], [self.root]
        while todo:
            at = todo.pop()
            d = pattern.distance(at)
            if d <= most:
                found.append((d, at))
            todo += [t for k, t in self.children[at].items() if d - most <= k <= d + most]
        return sorted(found)


def cut_forms(text: str, tolerance: Tolerance = USUAL) -> list[str]:
    """The beginnings of an entry that a cut-off value may show, compared as cores."""
    plain = undecorated(text)
    return [core(plain[:n]) for n in range(max(tolerance.least_beginning, int(len(plain) * tolerance.kept_share)), len(plain))]


class Matcher:
    """The trees of one block: whole entries and their beginnings. Entries are (text, target, order)."""

    def __init__(self, entries: Sequence[tuple[str, str, int]], tolerance: Tolerance = USUAL):
        self.tolerance = tolerance
        whole: dict[str, tuple[int, str]] = {}
        cut: dict[str, set[tuple[int, str]]] = {}
        for text, target, order in entries:
            c = core(text)
            if c:
                whole[c] = min(whole.get(c, (order, target)), (order, target))
                for f in cut_forms(text, tolerance):
                    cut.setdefault(f, set()).add((order, target))
        # a beginning shared by several targets tells nothing
        self._plant(whole, {f: min(t) for f, t in cut.items() if len({x for _, x in t}) == 1 and len(f) >= tolerance.least_beginning and f not in whole})

    @classmethod
    def of_forms(cls, forms: Sequence[tuple[str, str, int, int]], tolerance: Tolerance = USUAL) -> Matcher:
        """The trees of some of a block's forms (form, target, order, stage), which settled_forms has chosen over all of its entries."""
        self = cls.__new__(cls)
        self.tolerance = tolerance
        self._plant(*({f: (order, target) for f, target, order, at in forms if at == stage} for stage in (0, 1)))
        return self

    def _plant(self, whole: dict[str, tuple[int, str]], cut: dict[str, tuple[int, str]]) -> None:
        self.whole, self.cut = BKTree(whole), BKTree(cut)
        self.told: dict[str, tuple | None] = {}

    def best(self, text: str) -> tuple[int, int, int, str, str] | None:
        """(stage, distance, order, target, entry): the nearest whole entry (stage 0), else the nearest beginning (1); ties go to the least order."""
        c = core(text)
        if c not in self.told:
            if len(self.told) >= REMEMBERED:
                self.told.clear()
            self.told[c] = self._nearest(c)
        return self.told[c]

    def _nearest(self, c: str) -> tuple[int, int, int, str, str] | None:
        allowed = self.tolerance.edits(c)
        for stage, (tree, most) in enumerate(((self.whole, allowed), (self.cut, min(self.tolerance.beginning_edits, allowed)))):
            near = [(0, c)] if c in tree.value else tree.within(c, most)
            if near:
                return (stage, *min((d, *tree.value[e], e) for d, e in near))
        return None


_FOUND = "stage int, distance int, order int, target string, entry string"
_NONE = (None,) * 5


def _told(out: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(out, columns=["stage", "distance", "order", "target", "entry"]).astype({"stage": "Int32", "distance": "Int32", "order": "Int32"})


def _by_block(entries: Sequence[tuple], width: int) -> dict[tuple, list[tuple]]:
    found: dict[tuple, list] = {}
    for e in entries:
        found.setdefault(tuple(e[:width]), []).append(tuple(e[width:]))
    return found


def _looked_up(rows: DataFrame, entries: list[tuple], block: list[str], text: str, keep: list[str], tolerance: Tolerance) -> DataFrame:
    """Rows with the best entry of their block, looked up in one tree per block; each distinct value of a task once."""
    by_block, asked = _by_block(entries, len(block)), [f"__b{i}" for i in range(len(block))]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trees: dict[tuple, Matcher] = {}
        seen: dict[tuple, tuple] = {}
        for batch in batches:
            out = []
            for row in zip(*[batch[b] for b in asked], batch["__text"]):
                if row not in seen:
                    at, value = row[:-1], row[-1]
                    if at not in trees:
                        trees[at] = Matcher(by_block.get(at, []), tolerance)
                    if len(seen) >= REMEMBERED:
                        seen.clear()
                    seen[row] = (value is not None and trees[at].best(value)) or _NONE
                out.append(seen[row])
            yield pd.concat([batch[[f"__k_{k}" for k in keep]].reset_index(drop=True), _told(out)], axis=1)

    slim = rows.select(*[F.col(k).alias(f"__k_{k}") for k in keep], *[F.col(b).cast("string").alias(a) for b, a in zip(block, asked)], F.col(text).alias("__text"))
    schema = ", ".join([*(f"`__k_{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keep).schema), _FOUND])
    return slim.mapInPandas(run, schema)


def settled_forms(entries: DataFrame, block: list[str], tolerance: Tolerance = USUAL) -> DataFrame:
    """``(block, form, target, order, stage)``: what Matcher looks up, for lists of any length: whole entries (stage 0), and the beginnings (1) that stand for one target and aren't whole entries, over all entries of a block."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for *b, entry, target, order in zip(*[batch[c] for c in (*block, "entry", "target", "order")]):
                if c := core(entry):
                    cut = [f for f in cut_forms(entry, tolerance) if len(f) >= tolerance.least_beginning]
                    out += [(*b, f, target, order, stage) for stage, fs in enumerate(([c], cut)) for f in fs]
            yield pd.DataFrame(out, columns=[*block, "form", "target", "order", "stage"])

    kinds = {f.name: f.dataType.simpleString() for f in entries.schema}
    shape = ", ".join([*(f"`{b}` {kinds[b]}" for b in block), "form string", "target string", "order int", "stage int"])
    forms = entries.mapInPandas(run, shape)
    first = lambda stage: F.min(F.when(F.col("stage") == stage, F.struct("order", "target")))
    told = forms.groupBy(*block, "form").agg(first(0).alias("w"), first(1).alias("c"), F.count_distinct(F.when(F.col("stage") == 1, F.col("target"))).alias("n"))
    kept = told.where("w is not null or n = 1").withColumn("b", F.coalesce("w", "c"))
    return kept.select(*block, "form", "b.target", "b.order", F.when(F.col("w").isNull(), 1).otherwise(0).alias("stage"))


def map_to_reference(rows: DataFrame, text: str, block: list[str], entries: DataFrame, keep: list[str], most: int = MOST_ENTRIES, tolerance: Tolerance = USUAL, chunk: int = CHUNK) -> DataFrame:
    """``keep`` with ``target``, ``distance`` and ``entry`` of the nearest reference entry of the row's block; null where none is within the tolerance.

    ``entries`` has the block columns, ``entry``, ``target`` and ``order``
    (ties go to the least). Null, empty and unmatched values give nulls;
    repeated rows come out each; blocks are compared as text, and a null block
    is a block of its own. Lists above ``most`` entries are answered in shards,
    with the same results.
    """
    ship_package(rows.sparkSession)
    columns = [*[F.col(b).cast("string").alias(b) for b in block], "entry", "target", "order"]
    kept = [F.col(f"__k_{c}").alias(c) for c in keep]
    head = entries.select(*columns).limit(most + 1).collect()
    if len(head) <= most:
        return _looked_up(rows, [tuple(r) for r in head], block, text, keep, tolerance).select(*kept, "target", "distance", "entry")
    return _sharded(rows, text, block, entries.select(*columns), keep, most, tolerance, chunk)


def _sharded(rows: DataFrame, text: str, block: list[str], entries: DataFrame, keep: list[str], most: int, tolerance: Tolerance, chunk: int) -> DataFrame:
    """The answers of a list of any length: each shard of about ``most`` forms meets each chunk of about ``chunk`` distinct values in one group of one job, and the shards' winners merge.

    Which beginnings count is settled over the whole list before it is cut, so
    that the shards answer as one tree would.
    """
    asked = [f"__b{i}" for i in range(len(block))]
    value = [*asked, "__text"]
    slim = rows.select(*[F.col(k).alias(f"__k_{k}") for k in keep], *[F.col(b).cast("string").alias(a) for b, a in zip(block, asked)], F.col(text).alias("__text"))
    forms = written(settled_forms(entries, block, tolerance).select(*[F.col(b).alias(a) for b, a in zip(block, asked)], "form", "target", "order", "stage"), "forms")
    texts = written(slim.select(*value).where("__text is not null").distinct(), "asked")
    shards, chunks = -(-forms.count() // most), max(1, -(-texts.count() // chunk))
    part = lambda n, *c: F.pmod(F.xxhash64(*c), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = texts.withColumn("__chunk", part(chunks, *value)).withColumn("__shard", each(shards))
    right = forms.withColumn("__shard", part(shards, *asked, "form")).withColumn("__chunk", each(chunks))

    def answer(values: pd.DataFrame, those: pd.DataFrame) -> pd.DataFrame:
        by_block = _by_block(list(zip(*[those[c] for c in (*asked, "form", "target", "order", "stage")])), len(asked))
        trees = {at: Matcher.of_forms(fs, tolerance) for at, fs in by_block.items()}
        found = [(row, b) for row in zip(*[values[c] for c in value]) if row[:-1] in trees and (b := trees[row[:-1]].best(row[-1]))]
        return pd.concat([pd.DataFrame([r for r, _ in found], columns=value), _told([b for _, b in found])], axis=1)

    schema = ", ".join([*(f"`{c}` string" for c in value), _FOUND])
    won = left.groupBy("__shard", "__chunk").cogroup(right.groupBy("__shard", "__chunk")).applyInPandas(answer, schema)
    best = won.groupBy(*[F.col(c).alias(f"w{i}") for i, c in enumerate(value)]).agg(F.min(F.struct("stage", "distance", "order", "target", "entry")).alias("w"))
    same = F.lit(True)
    for i, c in enumerate(value):
        same = same & F.col(c).eqNullSafe(F.col(f"w{i}"))
    return slim.join(best, same, "left").select(*[F.col(f"__k_{c}").alias(c) for c in keep], "w.target", "w.distance", "w.entry")


def is_blank(c: Column) -> Column:
    return c.isNull() | ~F.coalesce(c.rlike(r"(?U)\S"), F.lit(False))
