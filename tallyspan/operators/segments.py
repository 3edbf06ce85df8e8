"""Segments of ordered rows between start and end markers, and the choice among them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tallyspan.operators.select import pick_first


def segment_rows(rows: DataFrame, key: Sequence[str], order: Sequence[str], start: Column, end: Column, block: Column | None = None) -> DataFrame:
    """Rows inside a segment with ``seg_no`` (from 1): after a start marker until the next marker of either kind. Marker rows are left out.

    Gaps and islands: a running count of starts numbers the segments, and the
    last marker seen says whether a row is inside. ``block`` is an expression
    that never falls as ``order`` rises, such as a page number: the running
    values are then taken within (key, block) and carried over from one
    summary row per block, so that a key with a third of all rows is spread
    over many tasks. A null block sorts first.
    """
    kind = F.when(F.coalesce(start, F.lit(False)), "start").when(F.coalesce(end, F.lit(False)), "end")
    marked = rows.withColumn("__m", kind).withColumn("__b", F.lit(0) if block is None else block)
    so_far = W.partitionBy(*key, "__b").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    counted = marked.withColumn("seg_no", F.count_if(F.col("__m") == "start").over(so_far)).withColumn("__last", F.last("__m", ignorenulls=True).over(so_far))
    if block is not None:
        told = F.when(F.col("__m").isNotNull(), F.struct(*order))
        blocks = marked.groupBy(*key, "__b").agg(F.count_if(F.col("__m") == "start").alias("__n"), F.max_by("__m", told).alias("__l"))
        earlier = W.partitionBy(*key).orderBy("__b").rowsBetween(W.unboundedPreceding, -1)
        before = blocks.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(key)], F.col("__b").alias("__kb"), F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__n0"), F.last("__l", ignorenulls=True).over(earlier).alias("__l0"))
        same = F.col("__b").eqNullSafe(F.col("__kb"))
        for i, k in enumerate(key):
            same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
        counted = counted.join(before, same).withColumn("seg_no", F.col("seg_no") + F.col("__n0")).withColumn("__last", F.coalesce("__last", "__l0"))
    return counted.where((F.col("__last") == "start") & F.col("__m").isNull()).select(*rows.columns, "seg_no")


def choose_segment(segmented: DataFrame, key: Sequence[str], tells: Column, least: int = 10) -> DataFrame:
    """``(key, seg_no, n_rows)``: the first segment with a telling row, else the longest of ``least`` rows or more, the first among equals."""
    sized = segmented.groupBy(*key, "seg_no").agg(F.count("*").alias("n_rows"), F.coalesce(F.bool_or(tells), F.lit(False)).alias("told")).where(F.col("told") | (F.col("n_rows") >= least))
    return pick_first(sized, key, [~F.col("told"), F.when(F.col("told"), F.col("seg_no")).otherwise(-F.col("n_rows")), F.col("seg_no")], ["seg_no", "n_rows"])


def text_lines(pages: DataFrame, key: Sequence[str], text: str) -> DataFrame:
    """``(key, line_no, line)`` of texts, numbered from 1."""
    return pages.select(*key, F.posexplode(F.split(F.col(text), r"\r?\n")).alias("__p", "line")).select(*key, (F.col("__p") + 1).alias("line_no"), "line")
