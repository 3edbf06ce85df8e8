"""Problem 2: the best representative of each group of records of one thing.

Currency reasoning. Where rows carry time stamps, the order in which a group's
values appear teaches which value replaces which; over all groups the
transitions are counted both ways, and the clear ones form a precedence graph.
Its topological levels order rows without stamps: each group is a partial
order, in which a row is later than another if both have stamps and its stamp
is later, or if a stamp is missing and its value's level is higher. The
topologically latest row ranks first among rows that the stated ranks (trust,
source) hold equal.

Groups are never collected: for each group and value only the first stamp is
kept, and a group's best row per aspect is the minimum of a rank. Spark
combines both before the shuffle, so a group holding a third of all rows costs
one row per map task.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Values an attribute may have for its precedence to be learnt.
MOST_VALUES = 16
_LAST = 2**63 - 1


@dataclass(frozen=True)
class Precedence:
    """Topological level of each value of an attribute: the higher, the later. ``transitions`` are (earlier, later, seen, seen in reverse, whether the precedence keeps it)."""

    levels: dict[str, int]
    transitions: tuple[tuple[str, str, int, int, bool], ...]

    def level(self, value: Column) -> Column:
        """Level of a value; null where nothing was learnt about it."""
        if not self.levels:
            return F.lit(None).cast("int")
        return F.try_element_at(F.create_map(*[F.lit(x) for p in sorted(self.levels.items()) for x in p]), value)


def learn_precedence(df: DataFrame, keys: Sequence[str], value: str, ts: str, margin: float = 1.2, least: int = 5) -> Precedence:
    """Which value of an attribute replaces which, from the groups' stamped rows.

    One value precedes another in a group if its first stamp is earlier. An
    edge is clear when seen ``least`` times and ``margin`` times as often as
    its reverse. Should clear edges form a cycle, the one with the weakest
    ratio is dropped until none is left. Rows without stamp, value or key teach
    nothing. More than MOST_VALUES values are an error: the attribute must be
    categorical.
    """
    seen = df.where(F.col(ts).isNotNull() & F.col(value).isNotNull())
    for k in keys:
        seen = seen.where(F.col(k).isNotNull())
    values = sorted(r[0] for r in seen.select(value).distinct().limit(MOST_VALUES + 1).collect())
    if len(values) > MOST_VALUES:
        raise ValueError(f"precedence is learnt for attributes of {MOST_VALUES} values at most")
    pairs = [(a, b) for a in range(len(values)) for b in range(len(values)) if a != b]
    if not pairs:
        return Precedence(dict.fromkeys(values, 0), ())
    stamp = F.unix_micros(ts)
    # keys are hashed, as only counts are wanted: a collision would shift a count by one
    firsts = seen.groupBy(F.xxhash64(*keys).alias("k")).agg(*[F.min(F.when(F.col(value) == v, stamp)).alias(f"v{i}") for i, v in enumerate(values)])
    counted = firsts.agg(*[F.count_if(F.col(f"v{a}") < F.col(f"v{b}")).alias(f"n{a}_{b}") for a, b in pairs]).first()
    n = {(values[a], values[b]): counted[f"n{a}_{b}"] for a, b in pairs}
    clear = {(a, b): (c, n[b, a]) for (a, b), c in n.items() if c >= least and c >= margin * n[b, a]}
    while (levels := topological_levels(values, clear)) is None:
        del clear[min(clear, key=lambda e: (clear[e][0] / (clear[e][1] + 1), e))]
    return Precedence(levels, tuple((a, b, c, n[b, a], (a, b) in clear) for (a, b), c in sorted(n.items())))


def topological_levels(values: list[str], edges) -> dict[str, int] | None:
    """Longest-path level of each value, None where the edges form a cycle."""
    into, out = dict.fromkeys(values, 0), defaultdict(list)
    for a, b in edges:
        into[b] += 1
        out[a].append(b)
    level, ready = dict.fromkeys(values, 0), [v for v in values if not into[v]]
    for v in ready:
        for b in out[v]:
            level[b] = max(level[b], level[v] + 1)
            into[b] -= 1
            if not into[b]:
                ready.append(b)
    return level if len(ready) == len(values) else None


def latest_first(ts: Column, level: Column, stamps_first: bool) -> list[Column]:
    """Ascending sort keys that put the topologically latest row first.

    ``stamps_first``: rows without a stamp come after all that have one, and
    levels order them among themselves. Otherwise levels come first and stamps
    decide among equal ones, so that a row without a stamp is the latest if
    its value replaces the others'.
    """
    stamp, step = F.coalesce(-F.unix_micros(ts), F.lit(_LAST)), -F.coalesce(level, F.lit(-1)).cast("int")
    return [stamp, step] if stamps_first else [step, stamp]


def partial_order_values(prefix: str, ts: Column, level: Column, meets: Column, value: Column) -> dict[str, tuple[Sequence[Column], Column, Column]]:
    """Entries of best_of_groups' ``values`` from which topologically_latest takes the latest row that meets a condition: the newest stamped row, the unstamped one of the highest level, and the highest level of a stamped row."""
    stamped, row = ts.isNotNull(), F.struct(level.alias("level"), value.alias("value"))
    step = -F.coalesce(level, F.lit(-1)).cast("int")
    return {
        f"{prefix}_stamped": ([-F.unix_micros(ts), step], meets & stamped, row),
        f"{prefix}_unstamped": ([step], meets & ~stamped, row),
        f"{prefix}_highest": ([step], meets & stamped & level.isNotNull(), level),
    }


def topologically_latest(prefix: str) -> Column:
    """Value of the latest row of a group's partial order; null where no row meets the condition.

    Stamps decide between stamped rows, levels where a stamp is missing, and
    an unknown level isn't comparable. So the newest stamped row is the
    latest, unless an unstamped one has a higher level than it and than all
    other stamped rows: were one of those higher, it would be later than the
    unstamped row, and the newest stamped row later still. Of rows that aren't
    comparable the stamped one counts.
    """
    stamped, unstamped = F.col(f"{prefix}_stamped"), F.col(f"{prefix}_unstamped")
    replaces = stamped["level"].isNotNull() & (unstamped["level"] > F.col(f"{prefix}_highest"))
    return F.when(stamped.isNull() | F.coalesce(replaces, F.lit(False)), unstamped["value"]).otherwise(stamped["value"])


def best_of_groups(
    df: DataFrame,
    keys: Sequence[str],
    row_id: str,
    ranks: Sequence[Column],
    ids: dict[str, Column],
    values: dict[str, tuple[Sequence[Column], Column, Column]] | None = None,
) -> DataFrame:
    """One row per group of two or more rows: keys, ``group_id``, ``n_rows``, ``survivor_id``, one id per entry of ``ids`` and one value per entry of ``values``.

    ``ranks`` are ascending, non-null whole numbers; the row id breaks ties,
    and group_id is the least row id. An entry of ``ids`` is a condition: its
    id is the first row that meets it, or the survivor where none does. An
    entry of ``values`` is (ranks of its own, condition, value), null where no
    row meets the condition. Rows with a null key belong to no group, rows
    with a null id are skipped. An empty table gives an empty result.
    """
    usable = F.col(row_id).isNotNull()
    for k in keys:
        usable = usable & F.col(k).isNotNull()
    ordered = lambda rs: F.struct(*[r.alias(f"r{i}") for i, r in enumerate(rs)], F.col(row_id).alias("id"))
    slim = [*[F.col(k) for k in keys], F.col(row_id).alias("__id"), ordered(ranks).alias("__rank")]
    slim += [meets.alias(f"__i_{n}") for n, meets in ids.items()]
    slim += [F.when(meets, F.struct(ordered(rs).alias("rank"), v.alias("value"))).alias(f"__v_{n}") for n, (rs, meets, v) in (values or {}).items()]
    aggs = [F.min("__id").alias("group_id"), F.count("*").alias("n_rows"), F.min("__rank").alias("__best")]
    aggs += [F.min(F.when(F.col(f"__i_{n}"), F.col("__rank"))).alias(f"__i_{n}") for n in ids]
    aggs += [F.min(f"__v_{n}").alias(f"__v_{n}") for n in values or {}]
    grouped = df.where(usable).select(*slim).groupBy(*keys).agg(*aggs).where("n_rows >= 2")
    survivor = F.col("__best.id")
    return grouped.select(
        *keys, "group_id", "n_rows", survivor.alias("survivor_id"),
        *[F.coalesce(F.col(f"__i_{n}.id"), survivor).alias(n) for n in ids],
        *[F.col(f"__v_{n}.value").alias(n) for n in values or {}],
    )
