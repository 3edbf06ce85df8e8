"""Problem 7 against the public encoders."""

import base64
import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyspan.llm import bpe

pytestmark = pytest.mark.skipif(not os.path.exists(bpe.RANKS_PATH), reason="no rank file here")


@pytest.fixture(scope="module")
def ours():
    with open(bpe.RANKS_PATH, "rb") as f:
        return bpe.MergeReplay(f.read())


@pytest.fixture(scope="module")
def theirs(ours):
    tiktoken = pytest.importorskip("tiktoken")
    return tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=ours.ranks, special_tokens={})


ODD = ["", " ", "\n\n \n", "a" * 20_000, "ab" * 10_000, " " * 3_000 + "x", "é ñ ü ß", "😀 emoji 👩‍👩‍👧", "<|endoftext|>", "it's we'll I'D", "1234567,89", "١٢٣ ４５", "​﻿\x00", "aaaa" * 33 + "bbb", "日本語テキスト"]


def test_odd_texts(ours, theirs):
    assert ours.encode(ODD) == [theirs.encode_ordinary(t) for t in ODD]
    assert ours.encode([None, "", None]) == [[], [], []]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=5))
def test_any_text(ours, theirs, texts):
    clean = [t.encode("utf-8", "ignore").decode() for t in texts]
    assert ours.encode(clean) == [theirs.encode_ordinary(t) for t in clean]


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="aab ", max_size=300))
def test_repetitive_text(ours, theirs, text):
    assert ours.encode([text]) == [theirs.encode_ordinary(text)]


def test_round_trip(ours):
    for t in ODD:
        assert b"".join(ours.bytes_of[i] for i in ours.encode([t])[0]).decode() == t


def test_forgetting_changes_nothing(ours, theirs):
    small = bpe.MergeReplay(b"\n".join(base64.b64encode(t) + b" %d" % r for t, r in ours.ranks.items()), remembered=2)
    texts = ["uno dos tres", "dos cuatro", "uno", "cinco seis dos"]
    assert [small.encode([t])[0] for t in texts] == [theirs.encode_ordinary(t) for t in texts]


def test_column(spark, theirs):
    rows = [(1, "hola mundo", "x"), (2, None, None), (3, "", "y"), (3, "hola mundo", "z"), (None, "a", None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    got = sorted(((r[0], r[1]) for r in bpe.encode_column(df, "text", ["doc_id"]).collect()), key=str)
    assert got == sorted(((d, theirs.encode_ordinary(t) if t else []) for d, t, _ in rows), key=str)
    assert bpe.encode_column(df.where("false"), "text", ["doc_id"]).collect() == []


def test_whole_table(spark, data, theirs):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    got = {r.doc_id: r.ids for r in bpe.encode_column(docs, "text", ["doc_id"]).collect()}
    assert got == {d: theirs.encode_ordinary(t) if t else [] for d, t in texts.items()}


def test_corpus_and_blocks_give_the_same_ids(spark, data, theirs):
    """With the whole dictionary, a part of it and none: the ids don't depend on which words were replayed beforehand."""
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(-i, t) for i, t in enumerate(ODD, 1)], docs.schema)
    both = docs.unionByName(odd)
    ids = lambda most: sorted((r.doc_id, r.ids) for r in bpe.encode_column(both, "text", ["doc_id"], most=most).collect())
    whole = ids(bpe.DICTIONARY_WORDS)
    assert whole == ids(300) == ids(0)
    assert dict(whole)[-4] == theirs.encode_ordinary(ODD[3])


def test_dictionary(spark, theirs):
    df = spark.createDataFrame([("uno dos uno",), ("uno tres",), (None,), ("",)], "text string")
    words = bpe.corpus_dictionary(df, "text")
    assert sorted((r.word, r.n, r.ids) for r in words.collect()) == sorted((w, n, theirs.encode_ordinary(w)) for w, n in (("uno", 2), (" dos", 1), (" uno", 1), (" tres", 1)))
    assert set(bpe.frequent_words(words, 2)) == {"uno"} and len(bpe.frequent_words(words, 4)) == 4 and bpe.frequent_words(words, 0) == {}
    assert bpe.corpus_dictionary(df.where("false"), "text").count() == 0
