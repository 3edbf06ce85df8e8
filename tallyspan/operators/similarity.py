"""Vector search, neighbour counts, PCA and clustering over an embedding column.

Searches take a stated query set against all rows, in blocks: a block of
queries is broadcast, each task multiplies it with its rows in batches and
keeps its own best, and the tasks' bests merge. No pair is emitted that isn't
asked for.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tallyspan.session import ship_package

#: Queries of one block, and blocks sent to the tasks at once.
QUERY_BLOCK, BLOCKS_HELD = 1024, 64


def _matrix(vectors, width: int) -> np.ndarray:
    """Unit rows; a zero or null vector and one of another width becomes a zero row, whose similarity is 0."""
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        if v is not None and len(v) == width:
            out[i] = np.nan_to_num(np.asarray(v, dtype=np.float64))
    size = np.linalg.norm(out, axis=1, keepdims=True)
    return np.divide(out, size, out=np.zeros_like(out), where=size > 0)


def _width(queries: DataFrame, vec_col: str) -> int:
    """The most frequent width of the query vectors, the greater among equals: that of the whole search, so that no result depends on how rows are batched."""
    widths = queries.where(F.col(vec_col).isNotNull()).groupBy(F.size(vec_col).alias("w")).count()
    top = widths.agg(F.max(F.struct("count", "w")).alias("m")).first().m
    return top.w if top else 0


def _packed_queries(queries: DataFrame, id_col: str, vec_col: str, width: int) -> DataFrame:
    """``(ids, vectors)``: the query vectors as unit rows in blocks of up to QUERY_BLOCK, packed by the executors."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), QUERY_BLOCK):
                part = batch.iloc[at : at + QUERY_BLOCK]
                yield pd.DataFrame({"ids": [part[id_col].to_numpy(dtype=np.int64).tobytes()], "vectors": [_matrix(part[vec_col].tolist(), width).tobytes()]})

    slim = queries.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias(id_col), vec_col)
    return slim.mapInPandas(run, "ids binary, vectors binary")


def _search(rows: DataFrame, queries: DataFrame, id_col: str, vec_col: str, per_task, schema: str) -> DataFrame:
    """Every row meets every query block; ``per_task(ids, query ids, similarities)`` reduces a batch to rows of ``schema``.

    Blocks are packed by the executors and reach the driver as bytes, at most
    BLOCKS_HELD at once: a pass over the rows takes that many together, so the
    passes are the queries divided by QUERY_BLOCK * BLOCKS_HELD.
    """
    spark = rows.sparkSession
    ship_package(spark)
    width = _width(queries, vec_col)
    slim = rows.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias(id_col), vec_col)
    parts, held = [], []

    def given() -> None:
        sent = spark.sparkContext.broadcast(list(held))
        held.clear()

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            blocks = [(np.frombuffer(i), np.frombuffer(v).reshape(-1, width)) for i, v in sent.value] if width else []
            blocks = [(i.view(np.int64), v) for i, v in blocks]
            for batch in batches:
                if len(batch):
                    ids, m = batch[id_col].to_numpy(dtype=np.int64), _matrix(batch[vec_col].tolist(), width)
                    for qid, q in blocks:
                        yield per_task(ids, qid, q @ m.T)

        parts.append(slim.mapInPandas(run, schema))

    for r in _packed_queries(queries, id_col, vec_col, width).toLocalIterator():
        held.append((bytes(r.ids), bytes(r.vectors)))
        if len(held) == BLOCKS_HELD:
            given()
    if held:
        given()
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)


def top_k(rows: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(query_id, neighbor_id, rank, similarity)``: the k nearest other rows of each query by cosine; ties go to the smaller id.

    Vectors are compared in the queries' most frequent width; others, null
    and zero ones have similarity 0.
    """
    schema = "query_id bigint, neighbor_id bigint, similarity double"

    def best(ids: np.ndarray, qid: np.ndarray, sims: np.ndarray) -> pd.DataFrame:
        rounded = np.where(ids[None, :] == qid[:, None], -np.inf, np.round(sims, 9))
        # all that reach the k-th greatest similarity, so that ties are settled by id below
        least = np.partition(rounded, -k, axis=1)[:, -k] if rounded.shape[1] > k else np.full(len(qid), -np.inf)
        q, r = np.nonzero((rounded >= least[:, None]) & np.isfinite(rounded))
        order = np.lexsort((ids[r], -rounded[q, r], q))
        q, r = q[order], r[order]
        kept = np.arange(len(q)) - np.searchsorted(q, q) < k
        return pd.DataFrame({"query_id": qid[q[kept]], "neighbor_id": ids[r[kept]], "similarity": sims[q[kept], r[kept]]})

    found = _search(rows, queries, id_col, vec_col, best, schema)
    ranked = found.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(F.desc(F.round("similarity", 9)), "neighbor_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "neighbor_id", "rank", "similarity")


def neighbor_counts(rows: DataFrame, queries: DataFrame, threshold: float, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(query_id, n, max_similarity)``: how many other rows reach the threshold, and the nearest one's similarity. Queries without a neighbour have n 0."""
    schema = "query_id bigint, n bigint, max_similarity double"

    def count(ids: np.ndarray, qid: np.ndarray, sims: np.ndarray) -> pd.DataFrame:
        sims = np.where(ids[None, :] == qid[:, None], -np.inf, sims)
        return pd.DataFrame({"query_id": qid, "n": (sims >= threshold).sum(axis=1), "max_similarity": sims.max(axis=1)})

    found = _search(rows, queries, id_col, vec_col, count, schema)
    return found.groupBy("query_id").agg(F.sum("n").alias("n"), F.max("max_similarity").alias("max_similarity"))


def similar_pairs(rows: DataFrame, queries: DataFrame, threshold: float, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(query_id, neighbor_id, similarity)``: every other row that reaches the threshold for a query; a pair of two queries comes out once, from the smaller id."""
    schema = "query_id bigint, neighbor_id bigint, similarity double"

    def over(ids: np.ndarray, qid: np.ndarray, sims: np.ndarray) -> pd.DataFrame:
        q, r = np.nonzero((sims >= threshold) & (ids[None, :] != qid[:, None]))
        return pd.DataFrame({"query_id": qid[q], "neighbor_id": ids[r], "similarity": sims[q, r]})

    found = _search(rows, queries, id_col, vec_col, over, schema)
    asked = queries.select(F.col(id_col).cast("bigint").alias("neighbor_id")).distinct()
    both = found.join(asked.withColumn("__q", F.lit(True)), "neighbor_id", "left")
    return both.where(F.col("__q").isNull() | (F.col("query_id") < F.col("neighbor_id"))).select("query_id", "neighbor_id", "similarity")


def violations(pairs: DataFrame, pair_threshold: float, neighbors: int = 2) -> DataFrame:
    """``(id, kind, n, line)`` of similar pairs ``(query_id, neighbor_id, similarity)``: ``pair`` for each at or above the pair threshold, and ``neighbors`` for each query with that many below it."""
    shown = F.format_number("similarity", 3)
    close = F.col("similarity") >= pair_threshold
    single = pairs.where(close).select(F.col("query_id").alias("id"), F.lit("pair").alias("kind"), F.lit(1).cast("bigint").alias("n"), F.concat(F.col("query_id").cast("string"), F.lit(" ~ "), F.col("neighbor_id").cast("string"), F.lit(": "), shown).alias("line"))
    grouped = pairs.where(~close).groupBy(F.col("query_id").alias("id")).agg(F.count("*").alias("n"), F.max("similarity").alias("top")).where(F.col("n") >= neighbors)
    many = grouped.select("id", F.lit("neighbors").alias("kind"), "n", F.concat(F.col("id").cast("string"), F.lit(": "), F.col("n").cast("string"), F.lit(" similar, up to "), F.format_number("top", 3)).alias("line"))
    return single.unionByName(many)


def pca(rows: DataFrame, vec_col: str = "embedding", variance: float = 0.99, out_col: str = "reduced") -> tuple[DataFrame, int]:
    """Rows projected on as many centred principal components as explain the share of variance, and their number. Null vectors are left out; an empty table gives none, in 0 components, and a single vector becomes zero."""
    from pyspark.ml.feature import PCA, StandardScaler
    from pyspark.ml.functions import array_to_vector, vector_to_array

    first = rows.where(F.size(vec_col) > 0).select(vec_col).first()
    if first is None:
        return rows.where("false").withColumn(out_col, F.array().cast("array<double>")), 0
    same = rows.where(F.size(vec_col) == len(first[0]))
    if same.limit(2).count() < 2:  # the centred vector is zero
        return same.withColumn(out_col, F.array(F.lit(0.0))), 1
    dense = same.withColumn("__v", array_to_vector(F.transform(vec_col, lambda x: x.cast("double"))))
    centred = StandardScaler(withMean=True, withStd=False, inputCol="__v", outputCol="__c").fit(dense).transform(dense)
    width = len(first[0])
    model = PCA(k=width, inputCol="__c", outputCol="__p").fit(centred)
    k = min(width, int(np.searchsorted(np.cumsum(model.explainedVariance.toArray()), variance) + 1))
    return model.transform(centred).withColumn(out_col, F.slice(vector_to_array("__p"), 1, k)).drop("__v", "__c", "__p"), k


def clusters(rows: DataFrame, k: int = 2, vec_col: str = "reduced", seed: int = 42) -> DataFrame:
    """Rows with ``cluster``, by k-means."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    dense = rows.withColumn("__v", array_to_vector(vec_col))
    return KMeans(k=k, seed=seed, maxIter=100, featuresCol="__v", predictionCol="cluster").fit(dense).transform(dense).drop("__v")


def split_proposal(rows: DataFrame, name: str, vec_col: str = "embedding", k: int = 2, seed: int = 42) -> DataFrame:
    """``(cluster, n, names)``: how the members of one collection, such as the functions of a file, fall into ``k`` groups by their vectors after PCA. Fewer members than groups give one group."""
    reduced, components = pca(rows.where(F.col(vec_col).isNotNull()), vec_col, 0.9)
    if not components or reduced.limit(k).count() < k:
        grouped = reduced.withColumn("cluster", F.lit(0))
    else:
        grouped = clusters(reduced, k, "reduced", seed)
    return grouped.groupBy("cluster").agg(F.count("*").alias("n"), F.sort_array(F.collect_list(name)).alias("names"))
