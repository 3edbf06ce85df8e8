"""Problem 4: records whose layout drifts from file to file.

Each file's fields are profiled (kind, value sketch, name tokens). Consecutive
files of a series are compared; fields that vanish and fields that appear are
matched as a bipartite assignment over name similarity and sketches, and the
matches above a threshold are renames.

Names that have nothing in common but mean the same field are learnt from all
files, without a list: a *standing* field is one that half of the records have;
another name stands for it if its values lie in the standing field's domain and
it is there only where the standing field isn't, more often than chance allows.

The files are range-partitioned by series and order, so that a series holding
a third of all files is spread over many tasks, and each task streams through
its sorted files holding one file at a time. What a task can't know, the state
of a series that began in an earlier partition, it leaves open in one *edge*
row per partition; the driver joins these edges in order. Their number is that
of the partitions, and each holds one file's profile.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field as dc_field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspan.session import ship_package, written

#: Share of the records that have a standing field, share of a name's values that its domain must hold, and the chance at which the name would miss the standing field that often anyway.
STANDING, CONTAINED, CHANCE = 0.5, 0.8, 0.01
#: Counts that a task holds before it hands them on.
HELD = 100_000
#: Least score of a rename.
RENAMED = 0.6


def tokens(name: str) -> tuple[str, ...]:
    """Lower-case words of a name in camelCase, snake_case, kebab-case or with blanks."""
    spaced = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name)
    return tuple(t for t in re.split(r"[^a-z0-9]+", spaced.lower()) if t)


def _short(a: tuple[str, ...], b: tuple[str, ...]) -> bool:
    """Word by word, one is the other or its beginning of three letters or more."""
    return len(a) == len(b) and all(x == y or (min(len(x), len(y)) >= 3 and (x.startswith(y) or y.startswith(x))) for x, y in zip(a, b))


def plain_name(name: str) -> str:
    return "_".join(tokens(name))


def _without_end(t: tuple[str, ...]) -> tuple[tuple[str, ...], ...]:
    """The words of a name without its first or its last one."""
    return (t[1:], t[:-1]) if len(t) > 1 else ()


def name_likeness(a: str, b: str, groups: Mapping[str, str] | None = None) -> float:
    """1 for the same words, less where ``groups`` knows them as one field, one has a word more in front or behind, or the words are abbreviated; else by shared bigrams. ``groups``: plain name to standing field."""
    ta, tb, told = tokens(a), tokens(b), groups or {}
    if ta == tb:
        return 1.0
    ga, gb = told.get("_".join(ta)), told.get("_".join(tb))
    if ga is not None and ga == gb:
        return 0.95
    if ga is not None and gb is not None:
        return 0.0
    longer, shorter = (ta, tb) if len(ta) > len(tb) else (tb, ta)
    if shorter and len(longer) == len(shorter) + 1 and shorter in _without_end(longer):
        return 0.92
    if _short(ta, tb):
        return 0.9
    if shorter and any(_short(t, shorter) for t in _without_end(longer)):
        return 0.85
    sa, sb = "".join(ta), "".join(tb)
    ba, bb = {sa[i : i + 2] for i in range(len(sa) - 1)}, {sb[i : i + 2] for i in range(len(sb) - 1)}
    return 0.7 * 2 * len(ba & bb) / max(1, len(ba) + len(bb))


def kind_of(value: object) -> str | None:
    if value is None:
        return None
    if isinstance(value, bool):
        return "flag"
    if isinstance(value, (int, float)):
        return "number"
    if isinstance(value, str):
        return "text"
    return "list" if isinstance(value, list) else "object"


def _bounded(text: str, most: int) -> str:
    """The text, or a hash of the whole of it where it is longer than ``most``; the hash has a 9 if the text has one."""
    if len(text) <= most:
        return text
    digest = hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()
    return ("9~" if "9" in text else "~") + digest.replace("9", "x")


def sketch(value: object) -> object:
    """A bounded form of a value: numbers and flags as they are, texts as the letter-digit shape and the content of the whole text, hashed where long."""
    if isinstance(value, str):
        shape = re.sub(r"[0-9]", "9", re.sub(r"[^\W\d_]+", "a", value))
        return [_bounded(shape, 64), _bounded(value, 32)]
    if isinstance(value, (list, dict)):
        return len(value)
    if isinstance(value, float) and not math.isfinite(value):
        return None
    return value


def value_likeness(a: list, b: list) -> float:
    """How alike two profiled values ``[kind, sketch]`` are, 0 to 1; 0.5 where either is null."""
    if a[0] is None or b[0] is None:
        return 0.5
    if a[0] != b[0]:
        return 0.0
    if a[0] == "number" and a[1] is not None and b[1] is not None:
        x, y = float(a[1]), float(b[1])
        if x == y:
            return 1.0
        if x == 0 or y == 0 or (x < 0) != (y < 0):
            return 0.3
        return max(0.0, 1.0 - abs(math.log10(abs(x) / abs(y))) / 2)
    if a[0] == "text" and a[1] and b[1]:
        return 1.0 if a[1][1] == b[1][1] else 0.8 if a[1][0] == b[1][0] else 0.2
    return 0.6


@dataclass(frozen=True)
class Names:
    """What is known of names: ``fields`` are different from each other, ``groups`` maps plain names to the standing field they mean."""

    fields: frozenset[str] = frozenset()
    groups: Mapping[str, str] = dc_field(default_factory=dict)

    def bases(self, name: str) -> set[str]:
        """The known fields that a name is, a word in front or behind aside."""
        t = tokens(name)
        return {b for x in (t, *_without_end(t)) if (b := "_".join(x)) in self.fields}


def rename_score(old: str, a: list, new: str, b: list, names: Names) -> float:
    """Two different known fields are never one field; otherwise the name counts most, and a telling text may stand in for it."""
    known = names.fields
    if old in known and new in known:
        return 0.0
    by_name, by_value = name_likeness(old, new, names.groups), value_likeness(a, b)
    if by_name < 0.9 and names.bases(old) & names.bases(new):
        by_name = 0.9
    score = 0.8 * by_name + 0.2 * by_value
    telling = a[0] == b[0] == "text" and bool(a[1]) and bool(b[1]) and min(len(a[1][1]), len(b[1][1])) >= 6 and (a[1][1] == b[1][1] or (a[1][0] == b[1][0] and "9" in a[1][0]))
    return max(score, 0.62) if telling and by_name > 0 and new not in known else score


def assign(score: list[list[float]]) -> list[tuple[int, int]]:
    """Pairs (row, column) of the assignment with the greatest sum of scores (shortest augmenting paths)."""
    if not score or not score[0]:
        return []
    n, m = len(score), len(score[0])
    if n > m:
        return sorted((i, j) for j, i in assign([[score[i][j] for i in range(n)] for j in range(m)]))
    u, v, match = [0.0] * (n + 1), [0.0] * (m + 1), [0] * (m + 1)
    for i in range(1, n + 1):
        match[0], j0 = i, 0
        least, way, used = [math.inf] * (m + 1), [0] * (m + 1), [False] * (m + 1)
        while True:
            used[j0] = True
            i0, delta, j1 = match[j0], math.inf, 0
            for j in range(1, m + 1):
                if not used[j]:
                    cost = -score[i0 - 1][j - 1] - u[i0] - v[j]
                    if cost < least[j]:
                        least[j], way[j] = cost, j0
                    if least[j] < delta:
                        delta, j1 = least[j], j
            for j in range(m + 1):
                if used[j]:
                    u[match[j]] += delta
                    v[j] -= delta
                else:
                    least[j] -= delta
            j0 = j1
            if match[j0] == 0:
                break
        while j0:
            match[j0] = match[way[j0]]
            j0 = way[j0]
    return sorted((match[j] - 1, j - 1) for j in range(1, m + 1) if match[j])


def match_renames(gone: dict[str, list], come: dict[str, list], names: Names) -> dict[str, str]:
    olds, news = sorted(gone), sorted(come)
    score = [[s if (s := rename_score(o, gone[o], n, come[n], names)) >= RENAMED else 0.0 for n in news] for o in olds]
    return {olds[i]: news[j] for i, j in assign(score) if score[i][j] > 0}


def record_of(content: str | None) -> tuple[bool, dict] | None:
    """Whether a file's record stands in a wrapper, and the record; null where the text is no JSON object."""
    try:
        top = json.loads(content) if content is not None else None
    except (ValueError, RecursionError):
        return None
    if not isinstance(top, dict):
        return None
    wrapped = isinstance(top.get("content"), dict)
    return wrapped, top["content"] if wrapped else top


def profile(content: str | None) -> dict | None:
    """``{"wrapped", "fields": {name: [kind, sketch]}}`` of one file; null where the text is no JSON object."""
    record = record_of(content)
    return None if record is None else {"wrapped": record[0], "fields": {k: [kind_of(x), sketch(x)] for k, x in record[1].items()}}


def layout_changes(before: dict, after: dict, names: Names) -> tuple[list[tuple[str, str, str]], dict[str, str]]:
    """``(field, change, new_field)`` rows between two profiles, kinds aside, and the renames."""
    rows = []
    if before["wrapped"] != after["wrapped"]:
        rows.append(("content", "nested" if after["wrapped"] else "flattened", ""))
    old, new = before["fields"], after["fields"]
    gone, come = {k: v for k, v in old.items() if k not in new}, {k: v for k, v in new.items() if k not in old}
    renames = match_renames(gone, come, names) if gone and come else {}
    rows += [(o, "renamed", n) for o, n in sorted(renames.items())]
    rows += [(o, "removed", "") for o in sorted(gone) if o not in renames]
    rows += [(n, "added", "") for n in sorted(come) if n not in set(renames.values())]
    return rows, renames


@dataclass
class Series:
    """State of the series being streamed. ``open``: it may have begun in an earlier partition."""

    key: tuple
    open: bool
    last: dict | None = None
    state: dict[str, tuple[str, str]] = dc_field(default_factory=dict)
    gone: set[str] = dc_field(default_factory=set)
    pending: list = dc_field(default_factory=list)

    def kind_state(self, name: str) -> tuple[str, str] | None:
        if name not in self.state and self.open and name not in self.gone:
            self.state[name] = ("p", name)
        return self.state.get(name)

    def step(self, file_id: int, now: dict, names: Names) -> list[tuple]:
        out = []
        if self.last is not None:
            rows, renames = layout_changes(self.last, now, names)
            out += [(file_id, *r) for r in rows]
            moved = {n: self.kind_state(o) for o, n in renames.items()}
            for o in renames:
                self.state.pop(o, None)
                self.gone.add(o)
            for n, s in moved.items():
                if s is None:
                    self.state.pop(n, None)
                    self.gone.add(n)
                else:
                    self.state[n] = s
        for name, (kind, _) in now["fields"].items():
            if kind is None:
                self.kind_state(name)
                continue
            was = self.kind_state(name)
            if was is not None and was[0] == "p":
                self.pending.append([was[1], file_id, name, kind])
            elif was is not None and was[1] != kind:
                out.append((file_id, name, "type_changed", ""))
            self.state[name] = ("k", kind)
        self.last = now
        return out


_OUT = "part int, file_id bigint, field string, change string, new_field string, edge string"


def _stream(names: Names, keys: list[str]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        now: Series | None = None
        head: dict | None = None

        def row(events: list[tuple]) -> pd.DataFrame:
            return pd.DataFrame([(part, *e, None) for e in events], columns=["part", "file_id", "field", "change", "new_field", "edge"])

        for batch in batches:
            events: list[tuple] = []
            for values in zip(*[batch[k] for k in keys], batch["file_id"], batch["content"]):
                key, file_id, content = tuple(None if pd.isna(v) else v for v in values[:-2]), int(values[-2]), values[-1]
                seen = profile(content)
                if seen is None:
                    continue
                if now is None or now.key != key:
                    if head is not None and head["whole"]:
                        head |= {"whole": False, "pending": now.pending}
                    now = Series(key, open=now is None)
                    if head is None:
                        head = {"key": list(key), "first": seen | {"file_id": file_id}, "whole": True}
                events += now.step(file_id, seen, names)
            yield row(events)
        if now is not None:
            if head["whole"]:
                head["pending"] = now.pending
            head |= {"tail": list(now.key), "last": now.last, "state": now.state, "gone": sorted(now.gone)}
            yield pd.DataFrame([(part, None, None, None, None, json.dumps(head))], columns=["part", "file_id", "field", "change", "new_field", "edge"]).astype({"file_id": "Int64"})

    return run


def join_edges(edges: list[dict], names: Names) -> list[tuple[int, str, str, str]]:
    """Changes at the borders of partitions, from their edges in order."""
    out: list[tuple] = []
    tail, last, kinds = None, None, {}
    for e in edges:
        if tail == e["key"] and last is not None:
            first = e["first"]
            rows, renames = layout_changes(last, first, names)
            out += [(first["file_id"], *r) for r in rows]
            moved = {n: kinds[o] for o, n in renames.items() if o in kinds}
            for o, n in renames.items():
                kinds.pop(o, None)
                kinds.pop(n, None)
            kinds |= moved
        else:
            kinds = {}
        out += [(f, name, "type_changed", "") for key, f, name, kind in e["pending"] if kinds.get(key, kind) != kind]
        kept = {n: k for n, k in kinds.items() if n not in e["state"] and n not in e["gone"]} if e["whole"] else {}
        told = {n: (s[1] if s[0] == "k" else kinds.get(s[1])) for n, s in e["state"].items()}
        kinds = kept | {n: k for n, k in told.items() if k is not None}
        tail, last = e["tail"], e["last"]
    return out


def learn_names(files: DataFrame, known: frozenset[str] = frozenset()) -> dict[str, str]:
    """Plain name to the standing field it means, the standing fields themselves included; ``known`` fields take no part.

    One scan of the files yields the names of each record and the values of
    each name, counted within the tasks; the rest works on that table. Whether
    a name avoids a standing field is judged by how often it would do so by
    chance; of several standing fields the one that holds most of its values
    counts. An empty table teaches nothing.
    """
    ship_package(files.sparkSession)
    plain_known = frozenset(map(plain_name, known))
    columns = ["name", "value", "n", "names"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter = Counter()
        plain: dict[str, str | None] = {}  # of each name met, None where it takes no part

        def asked(name: str) -> str | None:
            if name not in plain:
                if len(plain) >= HELD:
                    plain.clear()
                p = plain_name(name)
                plain[name] = None if p in plain_known else p or None
            return plain[name]

        for batch in batches:
            records = []
            for content in batch["content"]:
                record = record_of(content)
                if record is None:
                    continue
                found = {p: x for name, x in record[1].items() if (p := asked(name)) is not None}
                records.append((None, None, None, list(found)))
                for p, x in found.items():
                    kind = kind_of(x)
                    if kind in ("text", "number", "flag"):
                        value = sketch(x)
                        counts[p, f"{kind} {value[1] if kind == 'text' else value}"] += 1
            yield pd.DataFrame(records, columns=columns).astype({"n": "Int64"})
            if len(counts) > HELD:
                yield pd.DataFrame([(*k, n, None) for k, n in counts.items()], columns=columns)
                counts.clear()
        yield pd.DataFrame([(*k, n, None) for k, n in counts.items()], columns=columns)

    table = written(files.select("content").mapInPandas(run, "name string, value string, n bigint, names array<string>"), "names")
    records = table.where("names is not null").select("names")
    total = records.count()
    if not total:
        return {}
    of_name = records.select(F.explode("names").alias("a")).groupBy("a").agg(F.count("*").alias("of_a"))
    # at most the mean number of fields of a record / STANDING rows
    standing = {r.a: r.of_a for r in of_name.where(F.col("of_a") >= STANDING * total).collect()}
    if not standing:
        return {}
    listed = F.array(*[F.lit(b) for b in sorted(standing)])
    met = records.select("names", F.explode(F.array_intersect("names", listed)).alias("b")).select(F.explode("names").alias("a"), "b").where("a <> b").groupBy("a", "b").agg(F.count("*").alias("met"))
    values = table.where("name is not null").groupBy("name", "value").agg(F.sum("n").alias("n"))
    is_standing = F.col("name").isin(*standing)
    theirs, mine = values.where(is_standing).select(F.col("name").alias("b"), "value"), values.where(~is_standing).select(F.col("name").alias("a"), "value", "n")
    inside = mine.join(theirs, "value").groupBy("a", "b").agg(F.sum("n").alias("held"))
    judged = inside.join(mine.groupBy("a").agg(F.sum("n").alias("valued")), "a").join(of_name, "a").join(met, ["a", "b"], "left")
    of_b = F.try_element_at(F.create_map(*[F.lit(x) for b, n in sorted(standing.items()) for x in (b, n / total)]), F.col("b"))
    avoids = F.col("met").isNull() & (F.pow(1 - of_b, F.col("of_a")) <= CHANCE)
    share = F.col("held") / F.col("valued")
    best = judged.where(avoids & (share >= CONTAINED)).groupBy("a").agg(F.max(F.struct(share.alias("share"), of_b.alias("of_b"), "b")).alias("w")).select("a", "w.b")
    return {b: b for b in standing} | {r.a: r.b for r in best.toLocalIterator()}


def schema_changes(files: DataFrame, series: list[str], order: list[Column], known: set[str] | None = None, partitions: int | None = None, groups: Mapping[str, str] | None = None) -> DataFrame:
    """``(file_id, field, change, new_field)`` for each change from a file to the next of its series.

    ``files`` has the ``series`` columns, ``file_id`` and ``content``, a JSON
    text; ``order`` sorts the files of a series, and file_id breaks ties. A
    null series column is a value of its own. Files that hold no JSON object
    (null, empty, broken) take no part. Changes: ``nested``, ``flattened``,
    ``renamed``, ``removed``, ``added``, ``type_changed`` (field is the name in
    the later file). ``known`` names fields that are different from each other;
    ``groups``, names of one field, are learnt from the files unless given.
    An empty table gives an empty result.
    """
    ship_package(files.sparkSession)
    fields = frozenset(known or ())
    groups = learn_names(files, fields) if groups is None else groups
    told = Names(fields | {a for a, b in groups.items() if a == b}, groups)
    keys = [f"s{i}" for i in range(len(series))]
    ranks = [f"o{i}" for i in range(len(order))]
    slim = files.select(*[F.col(c).alias(n) for c, n in zip(series, keys)], *[o.alias(r) for o, r in zip(order, ranks)], "file_id", "content")
    by = [*keys, *ranks, "file_id"]
    spread = slim.repartitionByRange(partitions, *by) if partitions else slim.repartitionByRange(*by)
    raw = written(spread.sortWithinPartitions(*by).mapInPandas(_stream(told, keys), _OUT), "drift")
    edges = [json.loads(r.edge) for r in raw.where("edge is not null").select("part", "edge").orderBy("part").collect()]
    shape = "file_id bigint, field string, change string, new_field string"
    border = files.sparkSession.createDataFrame(join_edges(edges, told), shape)
    return raw.where("edge is null").select("file_id", "field", "change", "new_field").unionByName(border)


def unified_rows(files: DataFrame, keep: list[str], known: dict[str, set[str]], sheet: str, groups: Mapping[str, str] | None = None) -> DataFrame:
    """One row per file and field in a consistent layout: ``field`` is the known name a column matches, else its own snake_case name.

    Each file's columns are matched with the known fields of its sheet and the
    standing fields of all files (``groups`` as in schema_changes), so there is
    no shuffle of the files. ``value`` is the JSON text of the value, null for a
    null; files without a JSON object give no rows. The columns of ``keep``
    are carried along.
    """
    ship_package(files.sparkSession)
    fields = {k: sorted(v) for k, v in known.items()}
    groups = learn_names(files, frozenset().union(*known.values())) if groups is None else groups
    common = sorted({b for b in groups.values()})
    slim = files.select(*keep, "content")
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in files.select(*keep).schema), "field string", "name string", "kind string", "value string"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        settled: dict[tuple, dict[str, str]] = {}

        def canonical(names: tuple[str, ...], which: str) -> dict[str, str]:
            if (names, which) not in settled:
                due = [*fields.get(which, []), *common]
                told = {n: n for n in names if n in due}
                rest, free = [n for n in names if n not in told], [d for d in due if d not in told]
                score = [[s if (s := name_likeness(n, d, groups)) >= 0.8 else 0.0 for d in free] for n in rest]
                told |= {rest[i]: free[j] for i, j in assign(score) if score[i][j] > 0}
                if len(settled) > 5000:
                    settled.clear()
                settled[(names, which)] = {n: told.get(n, "_".join(tokens(n))) for n in names}
            return settled[(names, which)]

        for batch in batches:
            out = []
            for i, content in enumerate(batch["content"]):
                told = record_of(content)
                if told is None:
                    continue
                record = told[1]
                names = canonical(tuple(record), batch[sheet].iloc[i])
                out += [(i, names[k], k, kind_of(v), None if v is None else json.dumps(v, ensure_ascii=False)) for k, v in record.items()]
            rows = pd.DataFrame(out, columns=["__i", "field", "name", "kind", "value"])
            yield pd.concat([batch[keep].iloc[rows["__i"]].reset_index(drop=True), rows.drop(columns="__i")], axis=1)

    return slim.mapInPandas(run, schema)
