"""First-match and arg-max selection with explicit order, and primary-then-fallback chains."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspan.sources.tables import broadcast_if_small


def _ordered(order: Sequence[Column]) -> Column:
    return F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])


def pick_first(df: DataFrame, group: Sequence[str], order: Sequence[Column], take: Sequence[str], where: Column | None = None) -> DataFrame:
    """The ``take`` columns of each group's first row by ``order`` (ascending, nulls first).

    One aggregation with map-side combine, so a hot group costs one row per
    map task; ``order`` should end in a unique column. ``where`` limits the
    rows that count; a group without such rows doesn't come out.
    """
    rows = df if where is None else df.where(where)
    packed = F.struct(_ordered(order).alias("o"), *[F.col(c) for c in take])
    keyed = rows.select(*group, packed.alias("__p"))
    best = keyed.groupBy(*group).agg(F.min("__p").alias("__p")) if group else keyed.agg(F.min("__p").alias("__p")).where("__p is not null")
    return best.select(*group, *[F.col(f"__p.{c}").alias(c) for c in take])


def fallback_chain(candidates: DataFrame, wanted: DataFrame, name: str, rank: str, key: Sequence[str], order: Sequence[Column], value: str, need_value: bool = True) -> DataFrame:
    """Per key, the value under the first name of a ranked list of names that occurs.

    ``wanted`` is a small table of names with their rank (and what they feed).
    ``need_value``: a name counts only with a non-null value; otherwise its
    first row decides even if null.
    """
    joined = candidates.join(broadcast_if_small(wanted), name)
    return pick_first(joined, key, [F.col(rank), *order], [name, value], F.col(value).isNotNull() if need_value else None)


def top_rows(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows overall: partial top-n per task, then one merge."""
    return df.orderBy(*order).limit(n)
