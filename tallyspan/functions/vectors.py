"""Vector expressions over arrays of numbers."""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    """Sum of products; null elements count as 0, a missing tail too."""
    products = F.zip_with(a, b, lambda x, y: F.coalesce(x.cast("double") * y.cast("double"), F.lit(0.0)))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def unit(a: Column) -> Column:
    """The vector divided by its norm; a zero vector stays as it is."""
    n = norm(a)
    return F.transform(a, lambda x: F.when(n > 0, x.cast("double") / n).otherwise(x.cast("double")))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity, 0 where either vector has norm 0."""
    size = norm(a) * norm(b)
    return F.when(size > 0, dot(a, b) / size).otherwise(F.when(size.isNotNull(), F.lit(0.0)))


def concat_unit(*vectors: Column) -> Column:
    """The vectors laid end to end and scaled to norm 1."""
    return unit(F.concat(*[F.transform(v, lambda x: x.cast("double")) for v in vectors]))


def similarity_index(s: Column) -> Column:
    return F.lit(25.403) * F.pow(s, F.lit(5.0))


def refactor_index(cc: Column, cognitive: Column, index: Column) -> Column:
    return F.lit(0.25) * cc + F.lit(0.15) * cognitive + F.lit(0.6) * index


def packed(vector: Column) -> Column:
    """A vector as base64 text of its deflated 32-bit floats, for stores that hold texts only; null stays null."""

    def pack(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([None if v is None else base64.b64encode(zlib.compress(np.asarray(v, dtype="<f4").tobytes())).decode() for v in batch], dtype="object")

    return F.pandas_udf(pack, "string")(vector)


def unpacked(text: Column) -> Column:
    """The vector of a packed text; null where it is none."""

    def unpack(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out = []
            for t in batch:
                try:
                    out.append(None if t is None else np.frombuffer(zlib.decompress(base64.b64decode(t)), dtype="<f4").tolist())
                except (ValueError, zlib.error):
                    out.append(None)
            yield pd.Series(out, dtype="object")

    return F.pandas_udf(unpack, "array<float>")(text)
