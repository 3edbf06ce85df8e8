"""Problem 8: whole items, full containers, any partitioning."""

import math
import os
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tallyspan.llm import bpe, packing


def check(sizes, rows, capacity):
    """Every token of every item is in exactly one container, none is overfull, only large items are cut."""
    by_doc, fill = defaultdict(list), defaultdict(int)
    for r in rows:
        by_doc[r.doc_id].append(r)
        if r.container_id is not None:
            fill[r.container_id] += r.n_tokens
    assert set(by_doc) == set(sizes)
    for d, n in sizes.items():
        parts = sorted(by_doc[d], key=lambda r: r.piece_no)
        assert [(p.piece_no, p.start_token, p.n_tokens) for p in parts] == packing.pieces(n, capacity)
        assert all((p.container_id is None) == (p.n_tokens == 0) for p in parts)
    assert all(0 < n <= capacity for n in fill.values())
    return len(fill)


@pytest.mark.parametrize("parts,windows", [(1, 4), (7, 16), (40, 64)])
def test_sizes(spark, parts, windows):
    rng = random.Random(3)
    sizes = {i: rng.choice([0, 1, rng.randint(1, 300), rng.randint(1, 100), 1024, 1025, 2048, 2049, rng.randint(1, 9000)]) for i in range(2500)}
    df = spark.createDataFrame(list(sizes.items()), "id bigint, n int").repartition(parts, "id")
    check(sizes, packing.pack_sizes(df, "id", "n", windows=windows).collect(), packing.CAPACITY)


@pytest.mark.parametrize("parts", [1, 30])
def test_little_space_is_left(spark, parts):
    rng = random.Random(4)
    sizes = {i: min(40_000, int(rng.lognormvariate(5.6, 1))) for i in range(20_000)}
    df = spark.createDataFrame(list(sizes.items()), "id bigint, n int").repartition(parts, "id")
    used = check(sizes, packing.pack_sizes(df, "id", "n").collect(), packing.CAPACITY)
    assert used <= math.ceil(1.01 * sum(sizes.values()) / packing.CAPACITY)


def test_small_capacity_and_odd_rows(spark):
    df = spark.createDataFrame([(1, 5), (2, 5), (3, 6), (4, None), (5, -1), (6, 25)], "id bigint, n int").withColumn("container_id", F.lit("clash"))
    assert check({1: 5, 2: 5, 3: 6, 4: 0, 5: 0, 6: 25}, packing.pack_sizes(df, "id", "n", capacity=10).collect(), 10) == 5
    assert packing.pack_sizes(df.where("false"), "id", "n").count() == 0


def test_repeated_ids_come_out_each(spark):
    df = spark.createDataFrame([(1, 5), (1, 5), (None, 3)], "id bigint, n int")
    assert sorted((r.doc_id or 0, r.n_tokens) for r in packing.pack_sizes(df, "id", "n").collect()) == [(0, 3), (1, 5), (1, 5)]


def test_bounded_windows():
    packer, seen = packing.Packer(10, 3, 0), 0
    for i in range(500):
        packer.take(random.Random(i).randint(1, 9), (i,))
        seen = max(seen, len(packer.held))
    assert seen <= 3


@pytest.mark.skipif(not os.path.exists(bpe.RANKS_PATH), reason="no rank file here")
def test_texts(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    sizes = {r.doc_id: len(r.ids) for r in bpe.encode_column(docs, "text", ["doc_id"]).collect()}
    check(sizes, packing.pack_texts(docs).collect(), packing.CAPACITY)
