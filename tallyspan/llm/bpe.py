"""Problem 7: encoding a corpus by byte-level BPE through merge replay.

The distinct words of the whole corpus are counted in the JVM, combined before
the shuffle, and lie then in hash partitions. A task lays the words of its
partition out as one array of tokens with neighbour links, in blocks of
``BLOCK_WORDS``. An inverted index holds, for each pair of neighbouring tokens,
the positions where it stands; the pairs wait in a heap by the rank of their
merge. Taking the pairs in rank order replays every merge of the vocabulary
over all words, touching only the merged positions and their neighbours. A
merge never crosses a word, so cutting the words into blocks changes nothing.

The words and their ids are a written table. Documents are then lists of words
looked up in it: the words that are frequent enough to fit into
``DICTIONARY_WORDS`` are sent to every worker; the rest, words that are rare in
the corpus, are replayed again where they stand, with the same ids, since that
costs less than a shuffle of the exploded corpus to join them. A task keeps
them up to ``REMEMBERED`` and then forgets them as a whole, which costs time
only.
"""

from __future__ import annotations

import base64
import heapq
from collections import defaultdict
from collections.abc import Iterable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.session import ship_package, written

#: File of ranks: a base64 token and its rank on each line.
RANKS_PATH = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how the byte-level vocabulary splits a text into words.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Rare words that a task keeps encoded.
REMEMBERED = 400_000
#: Words replayed at once by a task, and words of the corpus sent to every worker at most.
BLOCK_WORDS, DICTIONARY_WORDS = 50_000, 200_000
#: Largest file of ranks that is sent to the executors.
MOST_RANK_BYTES = 64 << 20


class MergeReplay:
    """Encoder of words by replaying the merges of a rank file over blocks of distinct words; ``known`` are the rare words kept."""

    def __init__(self, rank_file: bytes, pattern: str = PATTERN, remembered: int = REMEMBERED):
        pairs = (line.split() for line in rank_file.splitlines() if line)
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.bytes_of = {r: t for t, r in self.ranks.items()}
        self.single = [self.ranks[bytes([b])] for b in range(256)]
        self.split = regex.compile(pattern).findall
        self.merged: dict[tuple[int, int], int] = {}
        self.known: dict[str, tuple[int, ...]] = {}
        self.remembered = remembered

    def _merge(self, a: int, b: int) -> int:
        """The token two neighbours merge to, -1 where the vocabulary has none; its id is its rank."""
        at = (a, b)
        found = self.merged.get(at)
        if found is None:
            found = self.merged[at] = self.ranks.get(self.bytes_of[a] + self.bytes_of[b], -1)
        return found

    def replay(self, words: list[bytes]) -> list[tuple[int, ...]]:
        """Ids of each word of a block."""
        tokens: list[int] = []
        before: list[int] = []
        after: list[int] = []
        starts: list[int] = []
        single, merge = self.single, self._merge
        index: dict[tuple[int, int], set[int]] = defaultdict(set)
        for w in words:
            at = len(tokens)
            starts.append(at)
            n = len(w)
            tokens += [single[b] for b in w]
            before += [-1, *range(at, at + n - 1)] if n else []
            after += [*range(at + 1, at + n), -1] if n else []
            for i in range(at, at + n - 1):
                pair = (tokens[i], tokens[i + 1])
                if merge(*pair) >= 0:
                    index[pair].add(i)
        heap = [(merge(*pair), pair) for pair in index]
        heapq.heapify(heap)
        while heap:
            new, pair = heapq.heappop(heap)
            places = index.pop(pair, None)
            if not places:
                continue
            a, b = pair
            for i in sorted(places) if a == b else places:
                j = after[i]
                if tokens[i] != a or j < 0 or tokens[j] != b:
                    continue
                left, right = before[i], after[j]
                if left >= 0:
                    old = index.get((tokens[left], a))
                    if old:
                        old.discard(left)
                if right >= 0:
                    old = index.get((b, tokens[right]))
                    if old:
                        old.discard(j)
                tokens[i], tokens[j] = new, -1
                after[i] = right
                if right >= 0:
                    before[right] = i
                    fresh = (new, tokens[right])
                    if (rank := merge(*fresh)) >= 0:
                        if fresh not in index:
                            heapq.heappush(heap, (rank, fresh))
                        index[fresh].add(i)
                if left >= 0:
                    fresh = (tokens[left], new)
                    if (rank := merge(*fresh)) >= 0:
                        if fresh not in index:
                            heapq.heappush(heap, (rank, fresh))
                        index[fresh].add(left)
        out = []
        for at, w in zip(starts, words):
            ids, i = [], at if w else -1
            while i >= 0:
                ids.append(tokens[i])
                i = after[i]
            out.append(tuple(ids))
        return out

    def replay_texts(self, words: list[str]) -> list[tuple[int, ...]]:
        return self.replay([w.encode("utf-8", "replace") for w in words])

    def encode(self, texts: Iterable[str | None], dictionary: Mapping[str, Sequence[int]] | None = None) -> list[list[int]]:
        """Ids of each text; an empty or null text has none. Words that ``dictionary`` lacks are replayed and kept."""
        split, known, given = self.split, self.known, dictionary or {}
        parts = [split(t) if t else [] for t in texts]
        rare = {w for p in parts for w in p if w not in given}
        new = [w for w in rare if w not in known]
        if len(known) + len(new) > self.remembered:
            known.clear()
            new = list(rare)
        known.update(zip(new, self.replay_texts(new)))
        return [[i for w in p for i in (given.get(w) or known[w])] for p in parts]


def rank_file(spark, path: str = RANKS_PATH):
    """The rank file as a broadcast, so that executors need no copy of their own. Its size is checked."""
    with open(path, "rb") as f:
        data = f.read(MOST_RANK_BYTES + 1)
    if len(data) > MOST_RANK_BYTES:
        raise ValueError(f"a rank file may have {MOST_RANK_BYTES} bytes at most")
    return spark.sparkContext.broadcast(data)


_WORKER: dict[tuple[int, int], MergeReplay] = {}


def worker_encoder(data: bytes) -> MergeReplay:
    """One encoder per Python worker and rank file, so that a reused worker keeps its words."""
    at = (len(data), hash(data))
    if at not in _WORKER:
        _WORKER.clear()
        _WORKER[at] = MergeReplay(data)
    return _WORKER[at]


def corpus_words(df: DataFrame, text: str) -> DataFrame:
    """``(word, n)``: the distinct words of all texts with the number of texts that hold them. Split by the JVM, whose notion of white space may differ from the encoder's in control characters; a word that only the encoder finds is rare to it."""
    words = df.where(F.col(text).isNotNull()).select(F.explode(F.array_distinct(F.regexp_extract_all(F.col(text), F.lit("(?U)" + PATTERN), F.lit(0)))).alias("word"))
    return words.where("word <> ''").groupBy("word").agg(F.count("*").alias("n"))


def corpus_dictionary(df: DataFrame, text: str, path: str = RANKS_PATH) -> DataFrame:
    """``(word, n, ids)``: every distinct word of the corpus with its ids, by merge replay in each hash partition. A written table."""
    ship_package(df.sparkSession)
    data = rank_file(df.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(data.value)
        held: list[pa.RecordBatch] = []

        def replayed() -> pa.RecordBatch:
            block = pa.Table.from_batches(held).combine_chunks()
            ids = encoder.replay_texts(block.column("word").to_pylist())
            return pa.RecordBatch.from_arrays([*(c.combine_chunks() for c in block.columns), _lists(ids)], names=["word", "n", "ids"])

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= BLOCK_WORDS:
                yield replayed()
                held.clear()
        if held:
            yield replayed()

    return written(corpus_words(df, text).mapInArrow(run, "word string, n bigint, ids array<int>"), "words")


def frequent_words(dictionary: DataFrame, most: int = DICTIONARY_WORDS) -> dict[str, tuple[int, ...]]:
    """The words whose count reaches the least power of two that ``most`` words at most reach; only these come to the driver."""
    power = F.floor(F.log2("n")).cast("int")
    counts = {r[0]: r[1] for r in dictionary.groupBy(power.alias("p")).count().collect()}
    least, total = 64, 0
    for p in sorted(counts, reverse=True):
        total += counts[p]
        if total > most:
            break
        least = p
    return {r.word: tuple(r.ids) for r in dictionary.where(power >= least).select("word", "ids").toLocalIterator()}


def _lists(encoded: Sequence[Sequence[int]]) -> pa.ListArray:
    sizes = np.fromiter((len(e) for e in encoded), dtype=np.int64, count=len(encoded))
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.fromiter((i for e in encoded for i in e), dtype=np.int32, count=int(sizes.sum()))))


def encode_column(df: DataFrame, text: str, keep: list[str], ids: str = "ids", path: str = RANKS_PATH, most: int = DICTIONARY_WORDS) -> DataFrame:
    """The columns ``keep`` with the ids of ``text`` as an array of int.

    An empty or null text gives an empty array; texts are encoded whole,
    however long, and special tokens have no meaning in them. An empty table
    gives an empty result. ``most`` bounds the words sent to every worker; 0
    leaves the replay to the tasks, one block of documents at a time.
    """
    spark = df.sparkSession
    ship_package(spark)
    data = rank_file(spark, path)
    words = spark.sparkContext.broadcast(frequent_words(corpus_dictionary(df, text, path), most) if most else {})
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, given = worker_encoder(data.value), words.value
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                encoded = encoder.encode(part.column(len(keep)).to_pylist(), given)
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], _lists(encoded)], names=[*keep, ids])

    return df.select(*keep, text).mapInArrow(run, f"{fields}, `{ids}` array<int>")
