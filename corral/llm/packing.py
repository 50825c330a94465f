"""Packing of documents into token windows by Karmarkar-Karp differencing."""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame

from corral.llm.common import map_batches, text_batches, texts_of
from corral.llm.encode import word_encoder

END = b"\0\0\0\0"
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, sequence_tokens long"
)


def karmarkar_karp(sizes: list[int], k: int) -> list[list[int]]:
    """Split the items into ``k`` windows of near-equal sums.

    Each item starts as a partial partition with one filled window.  The two
    partial partitions with the largest imbalance are merged, the largest
    window of one with the smallest of the other, until one is left.
    Returns the item numbers of each window; ties fall by item number.
    """
    if k <= 1:
        return [list(range(len(sizes)))]
    heap = []
    for i, s in enumerate(sizes):
        sums = np.zeros(k, dtype=np.int64)
        sums[0] = s
        heap.append((-int(s), i, sums, [(i,)] + [None] * (k - 1)))
    heapq.heapify(heap)
    tie = len(sizes)
    while len(heap) > 1:
        _, _, a, ga = heapq.heappop(heap)
        _, _, b, gb = heapq.heappop(heap)
        sums = a + b[::-1]
        order = np.argsort(-sums, kind="stable").tolist()
        both = [x if y is None else y if x is None else (x, y) for x, y in zip(ga, reversed(gb))]
        sums = sums[order]
        sums -= sums[-1]  # only differences matter
        heapq.heappush(heap, (-int(sums[0]), tie, sums, [both[j] for j in order]))
        tie += 1
    out = []
    for node in heap[0][3] if heap else [None] * k:
        items, todo = [], [node]
        while todo:
            x = todo.pop()
            if x is None:
                continue
            if len(x) == 1:
                items.append(x[0])
            else:
                todo.extend(x)
        out.append(sorted(items))
    return out


def windows(sizes: list[int], capacity: int) -> list[list[int]]:
    """Near-equal windows of at most ``capacity``: the window count starts at the
    least that could hold the items and rises whenever a window overflows."""
    k = max(1, -(-sum(sizes) // capacity))
    while True:
        groups = karmarkar_karp(sizes, k)
        if all(sum(sizes[i] for i in g) <= capacity for g in groups):
            return [g for g in groups if g]
        k += 1


class _Packer:
    """Packs one task's documents; holds one block of pieces at a time."""

    def __init__(self, capacity: int, block_windows: int, cut: int, slack: int, task: int):
        self.capacity, self.cut, self.task = capacity, cut, task
        self.room = block_windows * (capacity - slack)
        self.block: list[tuple] = []
        self.held = 0
        self.sequences = 0
        self.rows: dict[str, list] = {f.split()[0]: [] for f in PIECES.split(", ")}

    def _row(self, piece: tuple, seq: int, offset: int, total: int) -> None:
        doc_id, start, length, crc, doc_tokens = piece
        r = self.rows
        r["doc_id"].append(doc_id)
        r["start"].append(start)
        r["length"].append(length)
        r["ids_crc32"].append(crc)
        r["doc_tokens"].append(doc_tokens)
        r["sequence_id"].append(seq)
        r["offset"].append(offset)
        r["sequence_tokens"].append(total)

    def _sequence(self, pieces: list[tuple]) -> None:
        seq = (self.task << 40) | self.sequences
        self.sequences += 1
        total, offset = sum(p[2] for p in pieces), 0
        for p in pieces:
            self._row(p, seq, offset, total)
            offset += p[2]

    def add(self, doc_id, ids: bytes) -> None:
        n = len(ids) // 4
        start = 0
        piece = lambda a, b: (doc_id, a, b - a, zlib.crc32(ids[4 * a : 4 * b]), n)
        while n - start >= self.capacity:  # a full window needs no partner
            self._sequence([piece(start, start + self.capacity)])
            start += self.capacity
        while start < n:
            stop = min(n, start + self.cut, start + self.room - self.held)
            self.block.append(piece(start, stop))
            self.held += stop - start
            start = stop
            if self.held >= self.room:
                self.flush()

    def flush(self) -> None:
        for group in windows([p[2] for p in self.block], self.capacity) if self.block else []:
            self._sequence([self.block[i] for i in group])
        self.block, self.held = [], 0

    def take(self) -> dict[str, list]:
        rows, self.rows = self.rows, {k: [] for k in self.rows}
        return rows


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 1024,
    block_windows: int = 24,
    cut: int = 256,
    slack: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pack every document into sequences of at most ``capacity`` tokens.

    A document is its ids from the tokenizer file ``tokenizer`` followed by id
    0.  Whole windows of a long document are sequences of their own; the rest
    is cut into pieces of at most ``cut`` ids, gathered into blocks that fill
    about ``block_windows`` windows, and each block is split by Karmarkar-Karp
    differencing.  ``slack`` ids per window are left free so that near-equal
    windows fit; a block that still overflows gets one more window.

    One row per piece.  The work is one pass without a shuffle: a task holds
    one block (bounded), numbers its own sequences, and a lost task is redone
    alone with the same numbers.

    Null text: empty, so one id.  Null ids, repeated ids and repeated rows:
    every row is a document of its own.  Empty table: no rows.  Other columns
    are ignored.
    """

    def run(batches) -> Iterator[dict]:
        enc = word_encoder(tokenizer)
        packer = _Packer(capacity, block_windows, cut, slack, TaskContext.get().partitionId())
        for ids, texts in text_batches(batches):
            for doc_id, data in zip(ids, enc.encode(texts)):
                packer.add(doc_id, data + END)
            yield packer.take()
        packer.flush()
        yield packer.take()

    return map_batches(texts_of(docs, id_col, text_col), run, PIECES)
