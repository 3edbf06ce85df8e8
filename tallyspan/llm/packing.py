"""Problem 8: filling containers of fixed capacity with items of varying size.

Bounded-space online packing. Each partition keeps a fixed number of open
containers, puts an item into the open one it fits best, and, when none has
room, closes the fullest and opens another. What is still open when a
partition ends is left over: its items are packed again in fewer partitions,
round by round, until one partition remains, whose open containers are final.

A partition of the input holds ``windows`` open containers and never more,
whatever its size. Each later round shrinks the number of partitions by
``FAN_IN`` and packs in order of size, with room for everything that meets in
a partition: at most about ``FAN_IN * windows`` containers of items, since a
partition hands on no more than its ``windows`` emptiest containers.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.llm.bpe import RANKS_PATH, rank_file, worker_encoder
from tallyspan.session import ship_package, written

CAPACITY = 2048
WINDOWS = 128
#: Partitions of a round whose leftovers meet in one partition of the next.
FAN_IN = 16
#: Containers at least this full when a partition ends are closed, not packed again.
FULL = 0.995

_SHAPE = "doc_id bigint, piece_no int, start_token bigint, n_tokens int, container_id bigint, open boolean"


class Packer:
    """Open containers of one task, by free space. ``take`` returns the container an item goes into."""

    def __init__(self, capacity: int, windows: int, first: int):
        self.capacity, self.windows, self.next = capacity, windows, first
        self.by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.held: dict[int, list] = {}
        self.rooms = np.zeros(capacity + 1, dtype=np.int32)

    def take(self, size: int, item: tuple) -> list[tuple[int, list]]:
        """Put an item; returns the containers that closed, as (id, items)."""
        closed = []
        fits = np.flatnonzero(self.rooms[size:])
        if len(fits):
            room = size + int(fits[0])
            at = self.by_room[room].pop()
            self.rooms[room] -= 1
        else:
            if len(self.held) >= self.windows:
                room = int(np.flatnonzero(self.rooms)[0])
                full = self.by_room[room].pop()
                self.rooms[room] -= 1
                closed.append((full, self.held.pop(full)))
            at, room = self.next, self.capacity
            self.next += 1
            self.held[at] = []
        self.held[at].append(item)
        left = room - size
        if left == 0:
            closed.append((at, self.held.pop(at)))
        else:
            self.by_room[left].append(at)
            self.rooms[left] += 1
        return closed

    def rest(self) -> list[tuple[int, int, list]]:
        """What is open, the fullest first: (id, free space, items)."""
        return [(at, room, self.held[at]) for room, those in enumerate(self.by_room) for at in those]


def pieces(size: int, capacity: int) -> list[tuple[int, int, int]]:
    """(number, start, size) of an item's pieces: one unless it exceeds the capacity; none of an empty item but a record of it."""
    if size <= capacity:
        return [(0, 0, size)]
    return [(k, k * capacity, min(capacity, size - k * capacity)) for k in range(math.ceil(size / capacity))]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[]] * 6
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.bool_()]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)], names=["doc_id", "piece_no", "start_token", "n_tokens", "container_id", "open"])


def _pack_stream(items: Callable[[pa.RecordBatch], list[tuple]], capacity: int, windows: int, round_no: int, final: bool):
    """Task function: packs the items of its batches. An item is (doc_id, piece_no, start, size)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        packer = Packer(capacity, windows if round_no == 0 else 1 << 30, (round_no << 56) | (TaskContext.get().partitionId() << 32))
        for batch in batches:
            out = []
            for item in items(batch):
                if item[3] == 0:
                    out.append((*item, None, False))
                else:
                    for at, held in packer.take(item[3], item):
                        out += [(*x, at, False) for x in held]
            if out:
                yield _batch(out)
        rest = packer.rest()
        handed_on = set() if final else {at for at, room, _ in rest[-windows:] if room > capacity * (1 - FULL)}
        yield _batch([(*x, at, at in handed_on) for at, _, held in rest for x in held])

    return run


def pack_texts(df: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, windows: int = WINDOWS, path: str = RANKS_PATH) -> DataFrame:
    """``(doc_id, piece_no, start_token, n_tokens, container_id)``: where each piece of each text goes.

    Sizes are tokens of the rank file. Only a text above the capacity is cut,
    into full pieces and a rest. An empty or null text has one row of size 0
    without container. Every row of the input comes out; repeated doc_ids are
    packed each on its own. Container ids are unique but not dense.
    """
    spark = df.sparkSession
    ship_package(spark)
    data = rank_file(spark, path)

    def from_texts(batch: pa.RecordBatch) -> list[tuple]:
        encoder = worker_encoder(data.value)
        out = []
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            for d, ids in zip(part.column(0).to_pylist(), encoder.encode(part.column(1).to_pylist())):
                out += [(d, *p) for p in pieces(len(ids), capacity)]
        return out

    source = df.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return _rounds(source.mapInArrow(_pack_stream(from_texts, capacity, windows, 0, False), _SHAPE), capacity, windows)


def pack_sizes(df: DataFrame, doc_id: str, size: str, capacity: int = CAPACITY, windows: int = WINDOWS) -> DataFrame:
    """The same for items whose sizes are given; a null or negative size counts as 0."""
    ship_package(df.sparkSession)

    def from_sizes(batch: pa.RecordBatch) -> list[tuple]:
        return [(d, *p) for d, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for p in pieces(n, capacity)]

    source = df.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.greatest(F.lit(0), F.coalesce(F.col(size), F.lit(0))).cast("bigint").alias("size"))
    return _rounds(source.mapInArrow(_pack_stream(from_sizes, capacity, windows, 0, False), _SHAPE), capacity, windows)


def _rounds(packed: DataFrame, capacity: int, windows: int) -> DataFrame:
    """Pack what partitions left open in ever fewer partitions. Each round is a written table, since the outcome depends on the order of rows."""
    columns = ["doc_id", "piece_no", "start_token", "n_tokens", "container_id"]

    def again(batch: pa.RecordBatch) -> list[tuple]:
        return list(zip(*[batch.column(i).to_pylist() for i in range(4)]))

    done, now, round_no = [], written(packed, "packing"), 0
    parts = max(1, len(now.inputFiles()))  # a task writes one file at most
    while True:
        done.append(now.where("not open").select(*columns))
        left = now.where("open").select(*columns[:4])
        if round_no and parts == 1:
            break
        round_no, parts = round_no + 1, math.ceil(parts / FAN_IN)
        final = parts == 1
        spread = left.repartition(parts, F.xxhash64("doc_id", "piece_no")).sortWithinPartitions(F.desc("n_tokens"), "doc_id", "piece_no")
        now = written(spread.mapInArrow(_pack_stream(again, capacity, windows, round_no, final), _SHAPE), "packing")
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out
