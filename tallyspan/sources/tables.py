"""Parquet tables by name, and guarded broadcasts of rule tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows up to which a rule table may be sent to every executor.
RULE_ROWS = 10_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def broadcast_if_small(df: DataFrame, most: int = RULE_ROWS) -> DataFrame:
    """``broadcast(df)`` when a bounded count proves it small, otherwise ``df`` for a shuffled join.

    The count reads at most ``most + 1`` rows.
    """
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def settled_if_small(df: DataFrame, most: int = RULE_ROWS) -> DataFrame:
    """A computed table of few rows as a local one, to be broadcast, so that later uses don't compute it again; a larger one comes back as it is."""
    rows = df.limit(most + 1).collect()
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema)) if len(rows) <= most else df


def rule_rows(df: DataFrame, most: int = RULE_ROWS) -> list:
    """All rows of a rule table on the driver; an error if it holds more than ``most``.

    Rule tables are fixed by nature (fields, units, mappings). The bound is
    checked before anything is collected.
    """
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a rule table may have {most} rows at most")
    return rows


def as_literal(rules: DataFrame, most: int = RULE_ROWS) -> Column:
    """The rows of a rule table as one array literal of structs, so that rows can be matched with rules inside an expression, without a join."""
    kind = T.ArrayType(T.StructType([T.StructField(f.name, f.dataType) for f in rules.schema]))
    rows = [F.struct(*[F.lit(r[f.name]).cast(f.dataType).alias(f.name) for f in rules.schema]) for r in rule_rows(rules, most)]
    return F.array(*rows).cast(kind)


def with_each(df: DataFrame, rules: DataFrame) -> DataFrame:
    """Every row of ``df`` with each row of a rule table."""
    return df.select("*", F.inline(as_literal(rules)))
