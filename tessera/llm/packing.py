"""Packing of tokenised documents into windows by Karmarkar-Karp multiway differencing.

A document is its token ids and one end id.  Every full window of a long document is a window of
its own; what is left is a piece.  Pieces are gathered in batches of about ``BATCH_WINDOWS``
windows, and each batch is split into ``k`` windows by multiway differencing: every piece begins
as a partial partition (its size in one of k places), and the two partitions of the largest
imbalance are merged, large places with small ones, until one is left.  If its largest window
passes the capacity, the batch is split anew: first with its pieces cut finer (few large or equal
pieces cannot be balanced), then with k raised by one until every window fits.

A batch is closed by cutting the piece that would pass its size, so its windows are near full:
``SLACK`` tokens a window are left for the imbalance.  What a partition has beyond its last whole
window is cut into windows whose lengths are powers of two, which need no padding; so only the
slack and raised counts are padded.

Partitions are packed by themselves, in the order in which Spark reads them, so no row is
shuffled.  A sequence is numbered by its partition and its place there.  A task holds one batch.

A null text is empty: its document is the end id alone.  A null doc_id stays null; rows that
repeat a doc_id are documents of their own.  An empty table gives no pieces.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks as B
from .tokens import word_tokenizer

CAPACITY, BATCH_WINDOWS, SLACK, TAIL_UNIT, END_ID = 4096, 128, 16, 64, 2
PIECES = ("doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


def differencing(sizes: list[int], k: int) -> tuple[np.ndarray, np.ndarray]:
    """(window of each item, total of each window) of a near-equal partition into ``k`` windows."""
    n = len(sizes)
    if not n or k <= 1:
        return np.zeros(n, np.int64), np.array([sum(sizes)], np.int64)
    # partial partitions: sums in descending order, less the smallest; heap by imbalance
    sums: dict[int, np.ndarray] = {}
    heap = []
    for i, s in enumerate(sizes):
        v = np.zeros(k, np.int64)
        v[0] = s
        sums[i] = v
        heap.append((-s, i))
    heapq.heapify(heap)
    merges = []
    top = n
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        v = sums.pop(a) + sums.pop(b)[::-1]
        order = np.argsort(-v, kind="stable")
        v = v[order]
        v -= v[-1]
        sums[top] = v
        merges.append((a, b, order))
        heapq.heappush(heap, (-int(v[0]), top))
        top += 1
    # from the last merge down: which window each place of a partition belongs to
    place = {top - 1: np.arange(k)}
    window = np.zeros(n, np.int64)
    for node in range(top - 1, n - 1, -1):
        a, b, order = merges[node - n]
        own = np.empty(k, np.int64)
        own[order] = place.pop(node)
        for child, at in ((a, own), (b, own[::-1])):
            if child < n:
                window[child] = at[0]
            else:
                place[child] = at
    if n == 1:
        window[0] = 0
    return window, np.bincount(window, sizes, k).astype(np.int64)


def split(sizes: list[int], capacity: int = CAPACITY) -> np.ndarray:
    """The window of each item: as few windows as differencing can fill within ``capacity``."""
    total = sum(sizes)
    k = max(1, -(-total // capacity))
    while True:
        window, sums = differencing(sizes, k)
        if sums.max(initial=0) <= capacity:
            return window
        k += 1


class Packer:
    """Packs the documents of one partition as they stream by; rows are pieces."""

    def __init__(self, partition: int, capacity: int = CAPACITY, batch_windows: int = BATCH_WINDOWS,
                 slack: int = SLACK, unit: int = TAIL_UNIT):
        self.capacity, self.unit, self.next = capacity, unit, partition << 33
        self.slack = min(slack, capacity // 8)
        self.target = batch_windows * (capacity - self.slack)
        self.held, self.size, self.out = [], 0, []

    def add(self, doc_id, ids: np.ndarray) -> None:
        """One document, with its end id."""
        n, at = len(ids), 0
        while n - at >= self.capacity:
            self._window([(doc_id, at, ids[at:at + self.capacity], n)])
            at += self.capacity
        while at < n:
            take = min(n - at, self.target - self.size)
            self.held.append((doc_id, at, ids[at:at + take], n))
            self.size, at = self.size + take, at + take
            if self.size == self.target:
                self._close()

    def end(self) -> None:
        """Pack what is held: whole windows, and a tail of powers of two."""
        full = self.size // self.capacity
        # the tail takes a little more than the remainder: slack for the windows, and a whole unit
        tail = self.size - full * self.capacity
        if full:
            tail = -(-(tail + full * self.slack) // self.unit) * self.unit
        tail = min(tail, self.size)
        cut, rest = [], []
        left = self.size - tail
        for doc, at, ids, n in self.held:
            take = min(left, len(ids))
            if take:
                cut.append((doc, at, ids[:take], n))
            if take < len(ids):
                rest.append((doc, at + take, ids[take:], n))
            left -= take
        self.held = cut
        self._close()
        while rest:
            room = 1 << (min(sum(len(p[2]) for p in rest), self.capacity).bit_length() - 1)
            window = []
            while room:
                doc, at, ids, n = rest.pop(0)
                window.append((doc, at, ids[:room], n))
                if len(ids) > room:
                    rest.insert(0, (doc, at + room, ids[room:], n))
                room -= len(window[-1][2])
            self._window(window)

    def _close(self) -> None:
        if self.held:
            least = -(-self.size_held() // self.capacity)
            for finest in (8, 16, 64):
                window = differencing([len(p[2]) for p in self.held], least)
                if window[1].max() <= self.capacity:
                    break
                self._cut(max(1, self.capacity // finest))
            window = split([len(p[2]) for p in self.held], self.capacity)
            for w in range(int(window.max()) + 1):
                self._window([self.held[i] for i in np.flatnonzero(window == w)])
        self.held, self.size = [], 0

    def size_held(self) -> int:
        return sum(len(p[2]) for p in self.held)

    def _cut(self, most: int) -> None:
        """Cut the held pieces into pieces of at most ``most`` ids."""
        self.held = [(doc, at + i, ids[i:i + most], n) for doc, at, ids, n in self.held
                     for i in range(0, len(ids), most)]

    def _window(self, pieces: list) -> None:
        offset = 0
        for doc, at, ids, n in pieces:
            self.out.append((doc, at, ids, n, self.next, offset))
            offset += len(ids)
        self.next += bool(pieces)

    def take(self) -> list:
        out, self.out = self.out, []
        return out


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece of ``docs(doc_id, text)``: its place in the document, its ids (little-endian
    unsigned 32 bits), the document's tokens, its sequence and its place there."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                        ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])

    def rows(pieces):
        for i in range(0, len(pieces), 1024):
            p = pieces[i:i + 1024]
            yield B.batch_of(schema, [x[0] for x in p], [x[1] for x in p], [len(x[2]) for x in p],
                             [x[2].tobytes() for x in p], [x[3] for x in p], [x[4] for x in p], [x[5] for x in p])

    def run(batches):
        from pyspark import TaskContext
        tokens, packer = word_tokenizer(tokenizer_path), Packer(TaskContext.get().partitionId(), capacity)
        for part, data, off in B.blocks(batches):
            for doc, ids in zip(part.column("doc_id").to_pylist(), tokens.encode(data, off, end_id), strict=True):
                packer.add(doc, ids)
                if len(packer.out) >= 4096:
                    yield from rows(packer.take())
        packer.end()
        yield from rows(packer.take())

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text")).mapInArrow(run, PIECES)
